"""Location, reputation and risk of addresses.

Prefix tables are joined by equality: the address is masked to each prefix length
that the table holds, so that no pair of an address and a foreign range is ever made.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import ip, jsonpath
from sluice.functions.ip import first_address
from sluice.operators.model import Risk

#: Prefix rows up to which a table is broadcast (about 200 bytes each).
BROADCAST_PREFIXES = 100_000
#: Lengths of networks that are looked up one by one.
MOST_LENGTHS = 8
GEO = ("continent_code", "country_code", "country", "city", "latitude", "longitude", "timezone", "region", "region_code", "asn", "asn_org")
#: Flags that a kind of threat sets.
THREATS = {
    "vpn": ("is_vpn", "is_anonymizer"), "proxy": ("is_proxy", "is_anonymizer"), "tor": ("is_tor", "is_anonymizer"), "relay": ("is_relay", "is_anonymizer"),
    "datacenter": ("is_datacenter",), "botnet": ("is_botnet", "is_malicious"), "spam": ("is_spam",), "scanner": ("is_scanner",),
    "malware": ("is_malicious",), "phishing": ("is_malicious",), "bruteforce": ("is_malicious",), "exploit": ("is_malicious",), "blocklist": ("is_malicious",),
}
FLAGS = ("is_vpn", "is_proxy", "is_tor", "is_relay", "is_datacenter", "is_anonymizer", "is_botnet", "is_malicious", "is_spam", "is_scanner")
ALIASES = {"lat": "latitude", "lng": "longitude", "lon": "longitude", "isp": "asn_org", "org": "asn_org", "tz": "timezone", "state": "region", "cc": "country_code", "country_iso": "country_code", "country_name": "country", "continent": "continent_code", "zip": "postal_code", "as_number": "asn", "as_org": "asn_org"}


#: Where an event's address may lie, in order.
ADDRESS_FIELDS = ("src_ip", "client_ip", "ip", "source_ip")


def address_of(rows: DataFrame, fields: tuple[str, ...] = ADDRESS_FIELDS) -> Column:
    """The first non-empty of the address fields that ``rows`` has."""
    found = [F.col(f"`{f}`").cast("string") for f in fields if f in rows.columns]
    return first_address(*found) if found else F.lit(None).cast("string")


def named(ranges: DataFrame) -> DataFrame:
    """A location table with the names of GEO in place of the usual others (ALIASES)."""
    return ranges.select(*[F.col(f"`{c}`").alias(ALIASES[c]) if c in ALIASES and ALIASES[c] not in ranges.columns else F.col(f"`{c}`") for c in ranges.columns])


def _cut(a: Column, length: Column) -> Column:
    """struct(hi, lo) of an address cut to a number of bits."""
    masks = F.array(*[F.lit(0 if k == 0 else -(1 << (64 - k))).cast("long") for k in range(65)])
    part = lambda x, n: x.bitwiseAND(F.get(masks, F.greatest(F.lit(0), F.least(F.lit(64), n))))
    return F.struct(part(a["hi"], length).alias("hi"), part(a["lo"], length - 64).alias("lo"))


def prefixes(table: DataFrame, network: str = "network") -> DataFrame:
    """``table`` with the ``base`` and ``length`` of its networks of either kind, those of
    IPv4 as mapped ones (length 96 and more); a single address is a network of its own;
    rows that are neither are passed over.  A table without that column may have
    ``start_ip`` and ``end_ip``: each range is the fewest networks that make it up."""
    if network not in table.columns and {"start_ip", "end_ip"} <= set(table.columns):
        ends = jsonpath.once(table, "_ends", F.struct(ip.address(F.trim("start_ip")).alias("s"), ip.address(F.trim("end_ip")).alias("e")))
        made = ends.withColumn("_network", F.explode(ip.least_prefixes(F.col("_ends.s"), F.col("_ends.e"))))
        return made.withColumns({"base": F.col("_network.base"), "length": F.col("_network.length")}).drop("_ends", "_network")
    parts = F.split(F.trim(F.col(network)), "/")
    table = table.withColumn("base", ip.address(F.get(parts, F.lit(0)))).where("base is not null")
    size = F.when(ip.is_v4(F.col("base")) & ~F.col(network).contains(":"), F.lit(32)).otherwise(F.lit(128))
    length = F.when(F.size(parts) == 1, size).when(F.size(parts) == 2, F.get(parts, F.lit(1)).try_cast("int"))
    table = table.withColumns({"length": length, "_size": size}).where("length between 0 and _size")
    return table.withColumn("length", F.col("length") + 128 - F.col("_size")).drop("_size").withColumn("base", _cut(F.col("base"), F.col("length")))


def addressed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``_a`` and ``_private`` of the address in a column, read once; both are
    null for a text that is no address."""
    out = jsonpath.once(rows, "_a", ip.address(F.col(f"`{column}`").cast("string")))
    return out.withColumn("_private", F.when(F.col("_a").isNotNull(), ip.private(F.col("_a"))))


def _grouped(table: DataFrame) -> DataFrame:
    """(base, length, entries): the entries of each network, those of longer ``own`` first."""
    longest = F.sort_array(F.collect_list(F.struct((-F.col("own")).alias("n"), "entry")))
    return table.groupBy("base", "length").agg(F.transform(longest, lambda x: x["entry"]).alias("entries"))


def match_prefixes(rows: DataFrame, table: DataFrame, lengths: list[int]) -> DataFrame:
    """Every row of ``rows`` (_ip, _a) with every network of ``table`` (base, length, ...)
    that holds its address; rows without any are left out."""
    v4 = [n for n in lengths if n >= 96]
    of = lambda values: F.array(*map(F.lit, values)) if values else F.array().cast("array<int>")
    keyed = rows.withColumn("_length", F.explode(F.when(ip.is_v4(F.col("_a")), of(v4)).otherwise(of(lengths))))
    keyed = keyed.withColumn("_base", _cut(F.col("_a"), F.col("_length")))
    return keyed.join(table, (F.col("_base.hi") == F.col("base.hi")) & (F.col("_base.lo") == F.col("base.lo")) & (F.col("_length") == F.col("length"))).drop("_length", "_base")


def _stepped(table: DataFrame, step: int) -> DataFrame:
    """Networks as those of lengths that ``step`` divides: each as up to 2**(step - 1) longer
    ones, with its own length as ``own``."""
    more = F.pmod(-F.col("length"), F.lit(step)).cast("int")
    to = F.col("length") + more
    each = F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), more).cast("int") - 1))
    table = table.withColumn("own", F.col("length")).withColumns({"length": to, "_i": each})
    place = lambda k: F.expr(f"shiftleft(CAST(_i AS BIGINT), CAST(pmod({k} - length, 64) AS INT))")
    base = F.struct(F.when(F.col("length") <= 64, F.col("base.hi").bitwiseOR(place(64))).otherwise(F.col("base.hi")).alias("hi"), F.when(F.col("length") > 64, F.col("base.lo").bitwiseOR(place(128))).otherwise(F.col("base.lo")).alias("lo"))
    return table.withColumn("base", base).drop("_i")


def _masked(a: Column, n: int) -> tuple[Column, Column]:
    """``hi`` and ``lo`` of an address cut to ``n`` bits."""
    cut = lambda word, bits: F.lit(0).cast("long") if bits <= 0 else word if bits >= 64 else word.bitwiseAND(F.lit(-(1 << 64 - bits)).cast("long"))
    return cut(a["hi"], n), cut(a["lo"], n - 64)


def with_matches(rows: DataFrame, table: DataFrame, into: str) -> DataFrame:
    """``rows``, which have ``_a``, with ``into``: the entries of all networks of ``table``
    (base, length, entry) that hold the address, the longest network first.

    Of a table that is small enough the networks of each length are broadcast and looked
    up by the address cut to that length, so that no row moves and none is read twice;
    where there are many lengths, networks are spelt as those of every fourth.  For a
    larger table the distinct addresses are matched and joined back; rows without an
    address are dealt out by themselves.
    """
    table = _grouped(table.withColumn("own", F.col("length")))
    kind, held = table.schema["entries"].dataType, table.limit(BROADCAST_PREFIXES + 1).toArrow()
    if held.num_rows <= BROADCAST_PREFIXES:
        if len(set(held["length"].to_pylist())) > MOST_LENGTHS:
            held = _grouped(_stepped(rows.sparkSession.createDataFrame(held, table.schema).select("base", "length", F.explode("entries").alias("entry")), 4)).toArrow()
        found = []
        for n in sorted(set(held["length"].to_pylist()), reverse=True):
            mine = rows.sparkSession.createDataFrame(held.filter(pc.equal(held["length"], n)), table.schema)
            side = F.broadcast(mine.select(F.col("base.hi").alias("_hi"), F.col("base.lo").alias("_lo"), F.col("entries").alias(f"_entries_{n}")))
            hi, lo = _masked(F.col("_a"), n)
            mine = F.lit(True) if n >= 96 else ~ip.is_v4(F.col("_a"))
            rows = rows.join(side, (hi == F.col("_hi")) & (lo == F.col("_lo")) & mine, "left").drop("_hi", "_lo")
            found.append(f"_entries_{n}")
        every = F.flatten(F.array_compact(F.array(*found))) if found else F.array().cast(kind)
        return rows.withColumn(into, every).drop(*found)
    lengths = sorted(r["length"] for r in table.select("length").distinct().collect())  # 129 at most
    every = match_prefixes(rows.where("_a is not null").select("_a").distinct(), table, lengths)
    ordered = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("n"), "entries"))), lambda x: x["entries"]))
    best = every.groupBy("_a").agg(ordered.alias(into)).select(F.col("_a.hi").alias("_hi"), F.col("_a.lo").alias("_lo"), into)
    # rows without an address match nothing, wherever they are
    hi = F.coalesce(F.col("_a.hi"), F.monotonically_increasing_id() % 997)
    lo = F.coalesce(F.col("_a.lo"), F.lit(-1).cast("long"))
    keyed = rows.withColumns({"_key_hi": hi, "_key_lo": lo})
    out = keyed.join(best, (F.col("_key_hi") == F.col("_hi")) & (F.col("_key_lo") == F.col("_lo")), "left").drop("_hi", "_lo", "_key_hi", "_key_lo")
    return out.withColumn(into, F.when(F.col("_a").isNotNull(), F.coalesce(into, F.array().cast(best.schema[into].dataType))).otherwise(F.array().cast(best.schema[into].dataType)))


def _filled(rows: DataFrame, out: DataFrame, made: dict[str, Column]) -> DataFrame:
    """``rows`` with the columns ``made``, which leave alone what is there."""
    made = {k: F.coalesce(F.col(f"`{k}`"), v) if k in rows.columns else v for k, v in made.items()}
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def _geo(rows: DataFrame, out: DataFrame, ranges: DataFrame) -> DataFrame:
    """``geo_lookup`` of rows that are ``addressed`` in ``out``."""
    ranges = named(ranges)
    found = [c for c in GEO if c in ranges.columns]
    table = prefixes(ranges).select("base", "length", F.struct(*found).alias("entry"))
    met = jsonpath.once(with_matches(out, table, "_matches"), "_geo", F.when(~F.col("_private"), F.get("_matches", F.lit(0))))
    return _filled(rows, met, {f"geo_{c}": F.col(f"_geo.{c}") for c in found} | {"geo_is_private": F.col("_private")})


def geo_lookup(rows: DataFrame, address: str, ranges: DataFrame) -> DataFrame:
    """``rows`` with ``geo_`` columns from the longest network of ``ranges`` (network and
    columns of GEO) that holds the address; a private address has only
    ``geo_is_private``, an invalid one nothing.  Values already there stay.  Of several
    rows for one network any one counts."""
    return _geo(rows, addressed(rows, address), ranges)


def _reputation(rows: DataFrame, out: DataFrame, threats: DataFrame) -> DataFrame:
    """``reputation_lookup`` of rows that are ``addressed`` in ``out``."""
    table = prefixes(threats).select("base", "length", F.struct("order", "threat", "source", "score").alias("entry"))
    # all that is asked of the matches, once
    met = with_matches(out, table, "_matches").withColumn("_matches", F.array_sort("_matches"))
    of = lambda c: F.transform("_matches", lambda m: m[c])
    set_ = lambda c: F.array_sort(F.array_distinct(F.array_compact(of(c))))
    met = jsonpath.once(met, "_rep", F.struct(F.get("_matches", F.lit(0)).alias("first"), F.array_max(of("score")).alias("score"), set_("threat").alias("types"), set_("source").alias("sources")))
    flags = {f: F.arrays_overlap("_rep.types", F.array(*[F.lit(t) for t, fs in THREATS.items() if f in fs])) for f in FLAGS}
    several = lambda c: F.when(F.size(f"_rep.{c}") > 1, F.col(f"_rep.{c}"))
    made = {f"rep_{f}": F.coalesce(v, F.lit(False)) for f, v in flags.items()}
    made |= {"rep_threat_type": F.coalesce("_rep.first.threat", F.lit("none")), "rep_source": F.col("_rep.first.source"), "rep_abuse_score": F.when(F.col("_rep.score") > 0, F.col("_rep.score")), "rep_threat_types": several("types"), "rep_sources": several("sources")}
    return _filled(rows, met, made)


def reputation_lookup(rows: DataFrame, address: str, threats: DataFrame) -> DataFrame:
    """``rows`` with ``rep_`` columns from all networks of ``threats`` (network, threat,
    source, score, order) that hold the address: flags of any match, the first match
    by ``order`` as threat type and source, and all of either where there are several."""
    return _reputation(rows, addressed(rows, address), threats)


def risk(rows: DataFrame, settings: Risk = Risk(), gated: bool = False) -> DataFrame:
    """``rows`` with risk_score, risk_level and risk_factors from their ``geo_`` and
    ``rep_`` columns; a missing column counts as not found.  If ``gated``, rows of which
    neither lookup knows anything have none."""
    s = settings
    has = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False)
    country = F.col("geo_country_code") if "geo_country_code" in rows.columns else F.lit(None).cast("string")
    abuse = F.coalesce(F.col("rep_abuse_score"), F.lit(0)).cast("int") if "rep_abuse_score" in rows.columns else F.lit(0)
    listed = lambda names: country.isin(*names) if names else F.lit(False)
    geo = F.when(has("geo_is_private"), 0).when(country.isNull(), s.geo["unknown"]).when(listed(s.high_countries), s.geo["high"]).when(listed(s.medium_countries), s.geo["medium"]).otherwise(s.geo["other"])
    total = lambda columns: reduce(lambda a, b: a + b, columns, F.lit(0))
    reputation = F.least(F.lit(100), total(F.when(has(f"rep_is_{k}"), v).otherwise(0) for k, v in s.reputation.items()))
    hidden = total(has(f"rep_is_{k}").cast("int") for k in ("vpn", "proxy", "tor", "relay"))
    privacy = F.when(hidden == 0, 0).when(hidden == 1, s.privacy[0]).when(hidden == 2, s.privacy[1]).otherwise(s.privacy[2])
    threat = F.least(F.lit(100), total(F.when(has(f"rep_is_{k}"), v).otherwise(0) for k, v in s.threat.items()) + abuse)
    weight = sum(s.weights)
    scores = dict(zip(("geo", "reputation", "privacy", "threat"), (geo, reputation, privacy, threat), strict=True))
    staged = rows.withColumns({f"_{k}_risk": v.cast("int") for k, v in scores.items()})  # read once by all that follows
    scores = {k: F.col(f"_{k}_risk") for k in scores}
    composite = F.least(F.lit(100), F.floor(total(x * w for x, w in zip(scores.values(), s.weights, strict=True)) / weight)) if weight else F.lit(0)
    factors = F.array_compact(F.array(*[F.when(scores[k] >= low, f"{k} risk") for k, low in (("geo", s.geo["medium"]), ("reputation", 50), ("privacy", s.privacy[0]), ("threat", 80))]))
    level = F.lit("minimal")
    for name, low in reversed(s.bands.items()):
        level = F.when(F.col("risk_score") >= low, name).otherwise(level)
    staged = staged.withColumns({"risk_score": composite.cast("int"), "risk_factors": factors}).withColumn("risk_level", level)
    if gated:
        seen = [F.col(c).isNotNull() for c in rows.columns if c.startswith("geo_")] + [has(f"rep_{f}") for f in FLAGS if f"rep_{f}" in rows.columns]
        some = reduce(lambda a, b: a | b, seen, F.lit(False))
        staged = staged.withColumns({c: F.when(some, F.col(c)) for c in ("risk_score", "risk_factors", "risk_level")})
    return staged.drop(*[f"_{k}_risk" for k in scores])


@dataclass(frozen=True)
class Enrichment:
    """What a pipeline adds to records with an address: location, reputation and risk, each
    where its table, or its settings, are given."""

    ranges: DataFrame | None = None
    threats: DataFrame | None = None
    risk: Risk | None = None
    fields: tuple[str, ...] = ADDRESS_FIELDS


def enrich(rows: DataFrame, by: Enrichment) -> DataFrame:
    """``rows`` with the columns of ``by``; risk only where location or reputation found
    something.  The address of a row is read once for both lookups."""
    out = addressed(rows.withColumn("_address", address_of(rows, by.fields)), "_address")
    names = ["_address", "_a", "_private"]
    if by.ranges is not None:
        out = _geo(out, out, by.ranges)
    if by.threats is not None:
        out = _reputation(out, out, by.threats)
    out = risk(out, by.risk, gated=True) if by.risk is not None else out
    return out.drop(*names)
