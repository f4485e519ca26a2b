"""What happens to a message before it is a record: splitting of batches, and the
guards that turn a message into a dead letter.

Messages have the columns of a Kafka source: value (text), topic, partition, offset.
Each step adds or keeps ``_reject``, the reason of a dead letter, null while a message
is good; the first reason stands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import jsonpath

HEADER_KEYS = ("_org_id", "_source")
_BLANK = " \t\r\n"


def messages(rows: DataFrame, value: Column, topic: str = "events_land", offset: Column | None = None) -> DataFrame:
    """Rows of a batch table in the shape of a Kafka source."""
    at = F.monotonically_increasing_id() if offset is None else offset.cast("long")
    return rows.select(value.cast("string").alias("value"), F.lit(topic).alias("topic"), F.lit(0).alias("partition"), at.alias("offset"))


def _rejecting(df: DataFrame, bad: Column, reason: Column | str) -> DataFrame:
    before = F.col("_reject") if "_reject" in df.columns else F.lit(None).cast("string")
    return df.withColumn("_reject", F.coalesce(before, F.when(bad, F.lit(reason) if isinstance(reason, str) else reason)))


def _split(df: DataFrame, looks: Column, parts: Column) -> DataFrame:
    """A row for each of ``parts`` of a value that ``looks`` like a batch; a null list, as
    any other value, leaves the row alone."""
    own = F.array("value")
    return df.withColumn("value", F.explode(F.when(looks, F.coalesce(parts, own)).otherwise(own)))


def split_arrays(df: DataFrame) -> DataFrame:
    """A value that is a non-empty JSON array of objects alone becomes a row for each;
    any other value stays as it is.  Elements are the same JSON, without blanks."""
    looks = F.col("value").startswith("[") | F.col("value").rlike(r"^[ \t\r\n]+\[")
    objects = lambda x: F.when((F.size(x) > 0) & F.forall(x, lambda e: F.coalesce(e.startswith("{"), F.lit(False))) & F.rtrim("value").endswith("]"), x)
    return _split(df, looks, jsonpath.bound(F.from_json("value", "array<string>"), objects))


def split_lines(df: DataFrame) -> DataFrame:
    """A value of two or more JSON objects, each on a line of its own or over several
    lines with a line feed between them, becomes a row for each, byte for byte.

    A closing brace, a line feed and an opening brace with nothing but blanks between
    them stand only between whole objects: strings hold no raw line feeds, and inside
    an object a comma would come first.  All parts must be whole documents.
    """
    value = F.col("value")
    looks = F.contains(value, F.lit("\n")) & value.rlike(r"\}[ \t\r\n]*\n[ \t\r\n]*\{")
    parts = F.split(F.trim(value, F.lit(_BLANK)), r"(?<=\})[ \t\r]*\n[ \t\r\n]*(?=\{)")
    whole = lambda ps: F.when(F.forall(ps, lambda x: x.startswith("{") & _only(wrapped(x))), ps)
    return _split(df, looks, jsonpath.bound(parts, whole))


def gate(df: DataFrame) -> DataFrame:
    """Values whose first character is not that of a JSON object or array are rejected,
    with their leading bytes in the reason."""
    begins = F.coalesce(F.col("value").rlike(r"^[ \t\r\n]*[\{\[]"), F.lit(False))
    head = F.hex(F.substring(F.col("value").cast("binary"), 1, 8))
    return _rejecting(df, ~begins, F.concat(F.lit("not JSON, begins with "), F.coalesce(head, F.lit(""))))


#: What is no bracket: escapes, strings, all other text, and a quote that nothing closes.
#: Every loop is possessive, so that it neither goes back nor deepens the matcher's stack.
_PLAIN = r'(?s)(?:\\.|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"\\]|["\\])++'


def nesting(text: Column) -> Column:
    """Greatest depth of open brackets outside strings, by runs of opening brackets and of
    the closing ones that follow, not bracket by bracket."""
    runs = F.split(F.translate(F.regexp_replace(text, _PLAIN, ""), "[]", "{}"), r"(?<=\})(?=\{)")
    begin = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, run: Column) -> Column:
        opened = F.length(F.rtrim(run, F.lit("}")))
        now = acc["now"] + opened
        return F.struct((now + opened - F.length(run)).alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(runs, begin, step)["most"]


def _times(text: Column, part: str) -> Column:
    """How often ``part`` stands in a text."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def guard_depth(df: DataFrame, limit: int = 64) -> DataFrame:
    """Records nested past ``limit`` levels are rejected, array batches one level later.
    Only values with more opening brackets than that are measured."""
    value = F.col("value")
    most = F.lit(limit) + F.ltrim("value").startswith("[").cast("int")
    many = (F.length(value) > limit) & (_times(value, "{") + _times(value, "[") > limit)
    return _rejecting(df, F.coalesce(F.when(many, nesting(value) > most), F.lit(False)), f"nested past {limit} levels")


def _same(key: str):
    return lambda x: x == key


def guard_header_keys(df: DataFrame) -> DataFrame:
    """Records that repeat a header key at their top level are rejected; escapes in the
    keys are decoded.  Only values that hold a key twice, or escapes, are read for it."""
    value = F.col("value")
    for k in HEADER_KEYS:
        may = F.contains(value, F.lit("\\u")) | (_times(value, k) > 1)
        repeated = F.size(F.filter(F.json_object_keys("value"), _same(k))) > 1
        df = _rejecting(df, F.coalesce(F.when(may, repeated), F.lit(False)), f"header key {k} is repeated")
    return df


def wrapped(value: Column) -> Column:
    """The text as the only element of a JSON array, as a variant; null if that does not
    parse, as where something stands behind the text's document."""
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))


def _only(array: Column) -> Column:
    """Whether an array of ``wrapped`` holds one element and no more."""
    return F.coalesce(F.try_variant_get(array, "$[0]", "variant").isNotNull() & F.try_variant_get(array, "$[1]", "variant").isNull(), F.lit(False))


def parse(df: DataFrame) -> DataFrame:
    """Adds ``_record``, the value as a variant, for every good message; broken text,
    several records left in one value, and arrays are rejected.  A good message is
    parsed once."""
    good = F.lit(True)
    if "_reject" in df.columns:
        df = jsonpath.once(df, "_reject", F.col("_reject"))
        good = F.col("_reject").isNull()
    df = jsonpath.once(df, "_array", F.when(good, wrapped(F.col("value"))))
    array = F.ltrim("value").startswith("[")
    broken = F.col("_array").isNull()
    df = _rejecting(df, F.when(broken, F.try_parse_json("value").isNull()), "JSON parse error")
    df = _rejecting(df, array, "JSON array, not a record object")
    df = _rejecting(df, broken | ~_only(F.col("_array")), "several records that did not split")
    record = F.when(F.col("_reject").isNull(), F.try_variant_get("_array", "$[0]", "variant"))
    df = jsonpath.once(df, "_parsed", F.struct(F.col("_reject").alias("reject"), record.alias("record")))
    return df.withColumns({"_reject": F.col("_parsed.reject"), "_record": F.col("_parsed.record")}).drop("_array", "_parsed")


@dataclass(frozen=True)
class Filter:
    """Before routing: messages for which ``when`` (SQL over value, topic, partition and
    offset) holds are dropped, or rejected for ``reason``."""

    when: str
    reason: str | None = None


def prefilter(df: DataFrame, filters: tuple[Filter, ...]) -> DataFrame:
    """The first filter that holds decides."""
    if not filters:
        return df
    choice = F.lit(-1)
    for k, f in reversed(list(enumerate(filters))):
        choice = F.when(F.coalesce(F.expr(f.when), F.lit(False)), F.lit(k)).otherwise(choice)
    df = df.withColumn("_filter", choice)
    drop = [k for k, f in enumerate(filters) if f.reason is None]
    for k, f in enumerate(filters):
        if f.reason is not None:
            df = _rejecting(df, F.col("_filter") == k, f.reason)
    return df.where(~F.col("_filter").isin(drop)).drop("_filter")
