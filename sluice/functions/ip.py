"""Addresses: numbers, private ranges, selection, in DataFrame functions.

An address of either kind is 128 bits as two whole numbers, ``hi`` and ``lo``; one of
IPv4 counts as its mapped address (::ffff:0:0/96).
"""

from __future__ import annotations

import ipaddress
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.jsonpath import bound

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
V4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
#: Ranges that are not on the public internet (fixed by the public registries).
PRIVATE_V4 = (
    "0.0.0.0/32", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.2.0/24", "192.168.0.0/16",
    "198.51.100.0/24", "203.0.113.0/24", "255.255.255.255/32",
)
PRIVATE_V6 = ("::/128", "::1/128", "fc00::/7", "fe80::/10")
_MAPPED = 0xFFFF << 32


def v4_number(text: Column) -> Column:
    """An IPv4 address as a number; null for any other text."""
    number = F.aggregate(F.split(text, r"\."), F.lit(0).cast("long"), lambda n, x: n * 256 + x.cast("long"))
    return F.when(text.rlike(V4), number)


def _v6(text: Column) -> Column:
    """struct(hi, lo) of an IPv6 address; null for any other text."""

    def read(t: Column) -> Column:
        sides = F.split(t, "::")
        groups = lambda k: F.filter(F.split(F.coalesce(F.get(sides, F.lit(k)), F.lit("")), ":"), lambda g: g != "")
        padded = lambda gs: F.array_join(F.transform(gs, lambda g: F.lpad(g, 4, "0")), "")

        def made(x: Column) -> Column:
            n = F.size(x["left"]) + F.size(x["right"])
            fits = F.when(F.size(sides) == 2, n <= 7).otherwise(n == 8) & (F.size(sides) <= 2)
            hexes = F.concat(padded(x["left"]), F.repeat(F.lit("0000"), 8 - n), padded(x["right"]))
            part = lambda k: F.conv(F.substring(hexes, k, 16), 16, -10).cast("long")
            return F.when(fits, F.struct(part(1).alias("hi"), part(17).alias("lo")))

        shaped = t.rlike(r"^[0-9a-f:]+$") & ~t.rlike(r"[0-9a-f]{5}|^:[^:]|[^:]:$|:::")
        return F.when(shaped, bound(F.struct(groups(0).alias("left"), groups(1).alias("right")), made))

    def tail(n: Column) -> Column:
        return F.concat(F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(0xFFFF))))

    low = F.lower(text)
    dotted = F.concat(F.regexp_extract(low, r"^(.*:)[0-9.]+$", 1), bound(v4_number(F.regexp_extract(low, r":([0-9.]+)$", 1)), tail))
    return F.when(text.contains(":"), bound(F.when(text.contains("."), dotted).otherwise(low), read))


def address(text: Column) -> Column:
    """struct(hi, lo) of an address of either kind; null for any other text."""
    mapped = lambda n: F.when(n.isNotNull(), F.struct(F.lit(0).cast("long").alias("hi"), (n + _MAPPED).alias("lo")))
    return F.coalesce(bound(v4_number(text), mapped), _v6(text))


def is_v4(a: Column) -> Column:
    return (a["hi"] == 0) & (F.shiftrightunsigned(a["lo"], 32) == 0xFFFF)


def v4_bounds(network: str) -> tuple[int, int]:
    n = ipaddress.IPv4Network(network)
    return int(n.network_address), int(n.broadcast_address)


def private_v4(n: Column) -> Column:
    """Whether the number of an IPv4 address is private."""
    return reduce(lambda x, y: x | y, [n.between(low, high) for low, high in map(v4_bounds, PRIVATE_V4)])


def private(a: Column) -> Column:
    """Whether an ``address`` is private."""

    def held(network: str) -> Column:
        n = ipaddress.IPv6Network(network)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        hi, lo = (signed(int(n.network_address) >> s & (1 << 64) - 1) for s in (64, 0))
        return F.shiftrightunsigned(a["hi"], 64 - n.prefixlen) == int(n.network_address) >> 128 - n.prefixlen if n.prefixlen <= 64 else (a["hi"] == hi) & (a["lo"] == lo)

    return F.when(is_v4(a), private_v4(a["lo"] - _MAPPED)).otherwise(reduce(lambda x, y: x | y, map(held, PRIVATE_V6)))


def is_private_v4(text: Column) -> Column:
    """Whether an IPv4 address is private; null if it is none."""
    return bound(v4_number(text), private_v4)


def is_private(text: Column) -> Column:
    """Whether an address of either kind is private; null if it is neither."""
    return bound(address(text), lambda a: F.when(a.isNotNull(), private(a)))


def first_address(*columns: Column) -> Column:
    """The first of the columns that is not null or empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _top(x: Column) -> Column:
    """The place of the highest set bit of 64; -1 for none."""
    return F.when(x == 0, -1).otherwise(F.length(F.bin(x)) - 1)


def _power(k: Column) -> Column:
    """2**k as 64 bits, for k modulo 64."""
    return F.get(F.array(*[F.lit(-(1 << 63) if n == 63 else 1 << n).cast("long") for n in range(64)]), k % 64)


def _bit(a: Column, k: Column) -> Column:
    return F.when(k < 64, a["lo"]).otherwise(a["hi"]).bitwiseAND(_power(k)) != 0


def _from(a: Column, k: Column, one: bool) -> Column:
    """An address with bit ``k`` set (or not) and none below it."""

    def set_(w: Column) -> Column:
        masks = F.array(*[F.lit(0 if n == 63 else -(1 << n + 1)).cast("long") for n in range(64)])
        above = w.bitwiseAND(F.get(masks, k % 64))
        return above.bitwiseOR(_power(k)) if one else above

    return F.struct(F.when(k < 64, a["hi"]).otherwise(set_(a["hi"])).alias("hi"), F.when(k < 64, set_(a["lo"])).otherwise(F.lit(0).cast("long")).alias("lo"))


def least_prefixes(start: Column, end: Column) -> Column:
    """The fewest networks, array of struct(base, length), that together hold the addresses
    from ``start`` to ``end`` (both ``address``es) and no other; null if the first is
    greater.

    Let D be the highest bit in which both differ.  The half up to the middle is made of
    the block at the lowest set bit of ``start`` and one at every clear bit between
    that and D; the half from there of the block at the lowest clear bit of ``end`` and one
    at every set bit between that and D.  So each bit tells by itself what it adds.
    """
    word = lambda f: F.struct(f("hi").alias("hi"), f("lo").alias("lo"))
    top = lambda a: F.when(a["hi"] != 0, _top(a["hi"]) + 64).otherwise(_top(a["lo"]))
    low_bit = lambda x: F.when(x == F.lit(-(1 << 63)), 63).otherwise(_top(x.bitwiseAND(F.try_subtract(F.lit(0).cast("long"), x))))
    lowest = lambda a: F.when(a["lo"] != 0, low_bit(a["lo"])).when(a["hi"] != 0, low_bit(a["hi"]) + 64).otherwise(128)

    def made(x: Column) -> Column:
        s, e = x["s"], x["e"]
        d = top(word(lambda w: s[w].bitwiseXOR(e[w])))
        m, z = lowest(s), lowest(word(lambda w: F.bitwise_not(e[w])))

        def halves(n: Column) -> Column:
            d, m, z = n["d"], F.least(n["m"], n["d"]), F.least(n["z"], n["d"])
            block = lambda a, k: F.struct(a.alias("base"), (F.lit(128) - k).cast("int").alias("length"))
            between = lambda low: F.when(low + 1 < d, F.sequence(low + 1, d - 1)).otherwise(F.array().cast("array<int>"))
            left = F.transform(F.filter(between(m), lambda k: ~_bit(s, k)), lambda k: block(_from(s, k, True), k))
            right = F.transform(F.filter(between(z), lambda k: _bit(e, k)), lambda k: block(_from(e, k, False), k))
            ends = F.array(block(s, m), block(F.when(z == 0, e).otherwise(_from(e, F.greatest(z - 1, F.lit(0)), False)), z))
            # one block of both halves, where each is whole
            whole = (m == d) & (z == d)
            return F.when(d < 0, F.array(block(s, F.lit(0)))).when(whole, F.array(block(s, d + 1))).otherwise(F.concat(ends, left, right))

        return bound(F.struct(d.cast("int").alias("d"), m.cast("int").alias("m"), z.cast("int").alias("z")), halves)

    # without a sign the first bit counts as any other
    unsigned = lambda a: F.struct(a["hi"].bitwiseXOR(F.lit(-(1 << 63))), a["lo"].bitwiseXOR(F.lit(-(1 << 63))))
    good = F.when(start.isNotNull() & end.isNotNull() & (unsigned(start) <= unsigned(end)), F.struct(start.alias("s"), end.alias("e")))
    return F.when(good.isNotNull(), bound(good, made))
