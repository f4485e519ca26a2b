"""Functions of this library for SQL text of a session."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


class SplitRecords:
    """Rows (place, value) of the whole JSON objects in a text, however they are spread over
    lines or set side by side; what is none, and all behind it, comes last as it is."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        decoder, at, place, text = json.JSONDecoder(), 0, 0, text or ""
        while at < len(text):
            start = len(text) - len(text[at:].lstrip())
            if start == len(text):
                break
            try:
                value, at = decoder.raw_decode(text, start)
                if not isinstance(value, dict):
                    raise ValueError
            except ValueError:
                at = len(text)
            yield place, text[start:at].rstrip()
            place += 1


def register_python(spark: SparkSession) -> None:
    """The table function ``split_records(text)``, which Spark's own functions can't make.
    Aggregates of Python would bring a whole group to one task; for those there are
    ``operators.sketches``, which merge."""
    spark.udtf.register("split_records", F.udtf(SplitRecords, returnType="place int, value string"))


def register(spark: SparkSession) -> None:
    """Temporary SQL functions, made of Spark's own, so that the optimiser sees through them:
    ``epoch_time(number)`` (a whole number as nano-, micro-, milli- or plain seconds),
    ``is_private_ip(text)`` for IPv4, and ``risk_level(score)`` by the usual bands."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION epoch_time(n BIGINT) RETURNS TIMESTAMP RETURN timestamp_micros(
        CASE WHEN abs(n) > 1000000000000000000 THEN CAST(floor(CAST(n AS DECIMAL(20, 0)) / 1000) AS BIGINT) WHEN abs(n) > 1000000000000000 THEN n WHEN abs(n) > 1000000000000 THEN n * 1000 ELSE n * 1000000 END)""")
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION is_private_ip(t STRING) RETURNS BOOLEAN RETURN CASE WHEN t RLIKE '^{octet}([.]{octet}){{3}}$' THEN
        t RLIKE '^(10[.]|127[.]|192[.]168[.]|169[.]254[.]|172[.](1[6-9]|2[0-9]|3[01])[.]|100[.](6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])[.]|192[.]0[.]2[.]|198[.]51[.]100[.]|203[.]0[.]113[.]|0[.]0[.]0[.]0$|255[.]255[.]255[.]255$)' END""")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION risk_level(s INT) RETURNS STRING RETURN CASE WHEN s >= 80 THEN 'critical' WHEN s >= 60 THEN 'high' WHEN s >= 40 THEN 'medium' WHEN s >= 20 THEN 'low' WHEN s IS NOT NULL THEN 'minimal' END")
