"""Secret scans through a trigram inverted index, with DataFrame functions only.

Every rule is a regular expression.  ``trigram_query`` derives from it the trigrams
that any match must hold, as alternatives of which one must be there in full.  The
index holds a posting (trigram, text) for each trigram that some rule asks for;
postings are intersected per rule, and a rule's expression runs only on the texts
left over.  A rule without mandatory trigrams, such as a bare run of hex digits,
scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op  # the standard library's own parse of an expression
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import column, free_names, small_enough, stored, text_digest

#: Candidate texts up to which their keys are broadcast to the scan (about 100 bytes each).
BROADCAST_CANDIDATES = 200_000
_ALTERNATIVES = 64
#: Letters of a class that is spelt out as alternatives, at most.
_CLASS = 8
#: Matches, or spans, worked through at once, and letters of a piece of text: arrays grow
#: within such blocks only, so that the work follows the length of a text.
_BLOCK, _LETTERS = 256, 4096


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` has
    fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed by contract; [A-Z0-9] and [0-9a-f] runs are maximal, so their least lengths
#: may stand in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What follows the first line of a private key: all to its END line, no other such line
#: being between; where END is missing, the lines before the base64 text and its runs of
#: 16 letters and more, however many.  The runs are a possessive group, which Java's matcher
#: works through in a loop, where it would go a call deeper for each turn of another group.
_B64 = "[A-Za-z0-9+/=]"
_KEY_TO_END = r"[^-]*(?:-{1,4}[^-]+){0,16}-----END [A-Z ]{0,30}PRIVATE KEY-----"
_KEY_RUNS = r"(?:[\x20\t\r\n]*(?:Proc-Type|DEK-Info):[^\r\n]*){0,4}(?:[\x20\t\r\n\\]*" + _B64 * 16 + r"[A-Za-z0-9+/=\r\n\\]*)*+(?:[\x20\t]+[A-Za-z0-9+/]+={1,2})?"
MORE = (
    Rule("private_key", rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----(?:{_KEY_TO_END}|{_KEY_RUNS})"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _fragments(parsed, done: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """``done`` alternatives of literal pieces, each grown by ``parsed``; the last
    piece of an alternative is still open, and an empty one stands for a break."""
    for kind, value in parsed:
        if kind is op.LITERAL:
            done = [(*a[:-1], a[-1] + chr(value).lower()) for a in done]
        elif kind is op.SUBPATTERN:
            done = _fragments(value[-1], done)
        elif kind is op.IN and len(value) <= _CLASS and all(k is op.LITERAL for k, _ in value):
            done = [x for letter in value for x in _fragments([letter], done)]
        elif kind is op.BRANCH:
            done = [x for arm in value[1] for x in _fragments(arm, done)]
        elif kind is op.MAX_REPEAT and value[:2] == (0, 1) and all(k is op.LITERAL for k, _ in value[2]):
            done = done + _fragments(value[2], done)
        elif kind is op.MAX_REPEAT and value[0] > 0:
            done = [(*a, "") for a in _fragments(value[2], done)]
        elif kind is not op.AT:
            done = [(*a, "") for a in done]
        if len(done) > _ALTERNATIVES:
            raise ValueError("too many alternatives")
    return done


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which any text that matches holds in
    full; None if there is an alternative without trigrams, so that all texts must be
    scanned."""
    try:
        found = {frozenset(p[i : i + 3] for p in a for i in range(len(p) - 2)) for a in _fragments(_parser.parse(pattern), [("",)])}
    except ValueError:
        return None
    if frozenset() in found:
        return None
    return sorted((q for q in found if not any(o < q for o in found)), key=sorted)


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index over ``trigrams``: (trigram, text_key) for each text of
    ``docs`` (text) whose lower-case form holds the trigram."""
    lowered = docs.where("text is not null").select(text_digest(F.col("text")).alias("text_key"), F.lower("text").alias("low"))
    there = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return lowered.select("text_key", F.explode(there).alias("trigram")).where("trigram is not null")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(text_key, rules): texts that may match, with the numbers of the rules, for
    rules that have mandatory trigrams."""
    terms = [(t, r, c, i, len(q)) for r, rule in enumerate(rules) for c, q in enumerate(trigram_query(rule.pattern) or []) for i, t in enumerate(sorted(q))]
    spark = docs.sparkSession
    if not terms:
        return spark.sql("SELECT cast(null AS binary) AS text_key, array(0) AS rules WHERE false")
    values = ", ".join(f"({_lit(t)}, {r}, {c}, {1 << i}L, {(1 << n) - 1}L)" for t, r, c, i, n in terms)
    asked = spark.sql(f"SELECT * FROM VALUES {values} AS asked(trigram, rule, clause, bit, full)")
    held = postings(docs, sorted({t[0] for t in terms})).join(F.broadcast(asked), "trigram")  # a few terms per rule
    met = held.groupBy("text_key", "rule", "clause", "full").agg(F.bit_or("bit").alias("bits")).where("bits = full")
    return met.groupBy("text_key").agg(F.collect_set("rule").alias("rules"))


def _blocks(items: Column) -> Column:
    """An array as an array of arrays of ``_BLOCK`` of its items, one at least."""
    last = F.greatest(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)))


def _before(items: Column, value, join) -> Column:
    """For each item the values, not negative, of all before it, joined; one more than items."""
    start, add = F.lit(0), lambda acc, x: join(acc, value(x))

    def within(block: Column, first: Column) -> Column:
        return F.aggregate(block, F.array(first), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, F.lit(-1)), x))))

    blocks = _blocks(items)
    whole = F.transform(blocks, lambda b: F.aggregate(b, start, add))
    firsts = F.aggregate(whole, F.array(start), lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, F.lit(-1)), x))))
    inner = F.transform(blocks, lambda b, i: F.slice(within(b, F.element_at(firsts, i + 1)), F.lit(1), F.size(b)))
    return F.concat(F.flatten(inner), F.slice(firsts, F.size(firsts), F.lit(1)))


def _spans(rules: tuple[Rule, ...], number: Column) -> Column:
    """(start, kind number, end) of the matches in ``text`` of the rule of that number;
    code points, end exclusive.  The gaps between matches give their places."""
    of = lambda values: F.get(F.array(*map(F.lit, values)), number)
    pattern, least = of([r.pattern for r in rules]), of([r.least for r in rules])
    sizes = F.zip_with(
        F.split("text", pattern, -1),
        F.arrays_zip(F.regexp_extract_all("text", pattern, F.lit(0)).alias("whole"), F.regexp_extract_all("text", pattern, of([r.group for r in rules])).alias("measured")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(m["whole"]), F.lit(0)).alias("whole"), F.length(m["measured"]).alias("measured")),
    )

    def found(parts: Column) -> Column:
        ends = _before(parts, lambda x: x["gap"] + x["whole"], lambda a, b: a + b)
        spans = F.transform(parts, lambda x, i: F.struct((F.get(ends, i) + x["gap"]).alias("start"), number.alias("kind"), F.get(ends, i + 1).alias("end"), x["measured"].alias("measured")))
        kept = F.filter(spans, lambda x: x["measured"] >= least)
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    # bound once, so that the parts are made once
    return F.get(F.transform(F.array(sizes), found), F.lit(0))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, into: str = "spans") -> DataFrame:
    """``docs`` with its columns and ``into``: array of (start, kind, end) by start and
    kind, kind being the number of the rule.

    A null or empty text has none; a very long one is scanned whole.  Rows are not told
    apart by any id, so repeated rows, repeated or null ids are each scanned alike; an
    empty table gives an empty one.  A column of ``docs`` named ``into`` is replaced, all
    others stay, whatever their names.
    """
    key, asked_ = free_names(docs, "key", "rules")
    found = stored(candidates(docs, rules).select(F.col("text_key").alias(key), F.col("rules").alias(asked_)))
    if small_enough(found, BROADCAST_CANDIDATES):
        found = F.broadcast(found)
    joined = docs.join(found, text_digest(docs["text"]) == F.col(key), "left")
    unled = [F.when(F.col("text").rlike(r.pattern), F.lit(k)) for k, r in enumerate(rules) if trigram_query(r.pattern) is None]
    asked = F.array_compact(F.concat(F.coalesce(F.col(asked_), F.array().cast("array<int>")), F.array(*unled).cast("array<int>")))
    spans = F.array_sort(F.flatten(F.transform(asked, lambda k: _spans(rules, k))))
    return joined.select(*[column(docs, c) for c in docs.columns if c.lower() != into.lower()], spans.alias(into))


def of_kind(number: int):
    """A condition on spans: that they are of the rule of this number."""
    return lambda s: s["kind"] == number


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mark`` (overlapping spans by
    one); texts without secrets, and nulls, stay as they are, as do all other columns,
    whatever their names.  Empty and very long texts, repeated rows and empty tables
    count as in ``scan``."""
    spans, done = free_names(docs, "spans", "done")
    found = scan(docs, rules, spans)

    def cut(letters: Column, first: Column, past: Column) -> Column:
        """Letters ``first`` to before ``past`` of a text in pieces."""
        piece = F.floor(first / _LETTERS).cast("int")
        near = F.slice(letters, piece + 1, F.floor(past / _LETTERS).cast("int") - piece + 1)
        return F.substring(F.array_join(near, ""), first - piece * _LETTERS + 1, past - first)

    def marked(x: Column) -> Column:
        kept = F.transform(x["spans"], lambda s, i: F.when(s["start"] < F.get(x["ends"], i), F.lit("")).otherwise(F.concat(cut(x["letters"], F.get(x["ends"], i), s["start"]), F.lit(mark))))
        return F.concat(F.array_join(kept, ""), cut(x["letters"], F.element_at(x["ends"], F.lit(-1)), F.length("text")))

    letters = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_LETTERS}}}"), F.lit(0))
    ends = _before(F.col(spans), lambda s: s["end"], F.greatest)
    held = F.struct(F.col(spans).alias("spans"), ends.alias("ends"), letters.alias("letters"))
    text = F.when(F.size(spans) > 0, F.get(F.transform(F.array(held), marked), F.lit(0))).otherwise(F.col("text"))
    out = found.withColumn(done, text)
    return out.select(*[F.col(done).alias("text") if c == "text" else column(out, c) for c in docs.columns])


def redact_stage(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``redact`` of every row, with the same results for nulls, empty and very long texts,
    repeated rows and clashing names; a column ``n_chars`` is kept at the length of the
    text."""
    out = redact(docs, rules)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
