"""Networks of IPv4 and IPv6 addresses: the longest matching prefix (O-56).

An address becomes its family and its bits as hex digits (8 or 32 of them); an IPv6
address that maps an IPv4 one counts as that.  A network (``10.0.0.0/8``,
``2001:db8::/32``, a plain address is a network of one) is its family, prefix length
and the digits of its prefix, so an address lies in it exactly when the digits of its
own prefix of that length are the same: an equi-join.

``longest_match`` joins once for each prefix length that occurs (33 + 129 at most),
longest first.  Below the bounds all of these use one broadcast of the table.
Beyond them the short prefixes still are broadcast, as there are few of them and
each has many addresses; the long ones are shuffle joins.

An address or network that cannot be read matches nothing; host bits of a network
are cleared; a zone (``fe80::1%eth0``) is ignored.
"""

from __future__ import annotations

import ipaddress
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS, materialise

# Private, shared, loopback, link-local and unique-local networks.
PRIVATE_NETWORKS = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16",
                    "::1/128", "fc00::/7", "fe80::/10")

# Prefixes of up to so many bits are broadcast whatever the table's size: at most
# 2 ** 16 networks of each length and family.
SHORT_BITS = 16
_HEX = "0123456789abcdef"
_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
_MAPPED = "00000000000000000000ffff"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hex4(quad: Column) -> Column:
    """Eight hex digits of a dotted quad; NULL if it is none."""
    def digits(octets):
        number = sum((F.get(octets, F.lit(k)).try_cast("long") * (1 << (24 - 8 * k)) for k in range(4)), F.lit(0))
        return F.lower(F.lpad(F.hex(number), 8, "0"))
    return F.when(quad.rlike(_IPV4), _bound(F.split(quad, r"\."), digits))


def _hex6(text: Column) -> Column:
    """32 hex digits of an IPv6 address; NULL if it is none."""
    # A dotted quad at the end stands for two groups.
    head = F.regexp_replace(text, r"[0-9.]+$", "")
    plain = F.when(~text.contains("."), text).otherwise(_bound(
        _hex4(F.regexp_extract(text, r"([0-9.]+)$", 1)),
        lambda tail: F.concat(head, F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))))

    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))

    def filled(halves: Column) -> Column:
        """The groups before and after ``::``, zeros in between."""
        def fill(both):
            left, right = both["left"], both["right"]
            missing = F.lit(8) - F.size(left) - F.size(right)
            fits = F.when(F.size(halves) == 1, missing == 0).otherwise((F.size(halves) == 2) & (missing >= 1))
            return F.when(fits, F.concat(left, F.array_repeat(F.lit("0"), missing), right))
        return _bound(F.struct(groups(F.get(halves, F.lit(0))).alias("left"),
                               groups(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("right")), fill)

    def joined(whole: Column) -> Column:
        return F.when(F.forall(whole, lambda g: g.rlike(r"^[0-9a-f]{1,4}$")),
                      F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))

    return _bound(_bound(F.split(plain, "::", -1), filled), joined)


def address_digits(address: Column) -> Column:
    """``4`` or ``6`` and the address's bits as hex digits; NULL for no address."""
    def six(digits):
        return F.when(digits.startswith(_MAPPED), F.concat(F.lit("4"), F.substring(digits, 25, 8))).otherwise(
            F.concat(F.lit("6"), digits))

    def read(text):
        return F.when(text.contains(":"), _bound(_hex6(text), six)).otherwise(F.concat(F.lit("4"), _hex4(text)))

    return _bound(F.lower(F.trim(F.split(address, "%")[0])), read)


def prefix(digits: Column, bits: int) -> Column:
    """The first ``bits`` bits of ``digits``, the family left out."""
    whole, part = divmod(bits, 4)
    out = F.substring(digits, 2, whole)
    if part:
        mask = 0xF << (4 - part) & 0xF
        masked = "".join(_HEX[int(d, 16) & mask] for d in _HEX)
        out = F.concat(out, F.translate(F.substring(digits, 2 + whole, 1), _HEX, masked))
    return out


def parse_networks(table: DataFrame, col: str = "network") -> DataFrame:
    """``table`` with ``family`` (4 or 6), ``bits`` and ``prefix`` in place of ``col``;
    rows whose network cannot be read are dropped."""
    at = F.split(F.col(f"`{col}`"), "/", -1)
    digits = address_digits(F.get(at, F.lit(0)))
    family = F.substring("__digits", 1, 1).cast("int")
    most = F.when(family == 4, 32).otherwise(128)
    given = F.get(at, F.lit(1))
    # A mapped network (::ffff:10.0.0.0/104) is that of its last 32 bits.
    is_mapped = (family == 4) & F.get(at, F.lit(0)).contains(":")
    bits = F.when(F.size(at) == 1, most).when((F.size(at) == 2) & given.rlike(r"^\d{1,3}$"),
                                              given.cast("int") - F.when(is_mapped, 96).otherwise(0))
    rows = table.withColumn("__digits", digits).where("__digits is not null").withColumns({"family": family, "bits": bits}).where(
        F.col("bits").between(0, F.when(F.col("family") == 4, 32).otherwise(128)))
    # The prefix of each length by one lookup: full digits, then the masked one.
    whole, part = F.floor(F.col("bits") / 4).cast("int"), F.pmod("bits", F.lit(4))
    digit = F.substring("__digits", F.lit(2) + whole, F.lit(1))
    last = F.lit("")
    for n in (1, 2, 3):
        last = F.when(part == n, F.substring(prefix(F.concat(F.lit("4"), digit), n), 1, 1)).otherwise(last)
    return rows.withColumn("prefix", F.concat(F.substring("__digits", F.lit(2), whole), last)).drop("__digits", col)


def in_networks(address: Column, networks: Iterable[str] = PRIVATE_NETWORKS) -> Column:
    """Whether the address lies in any of a few literal networks (no join); false
    for no address."""
    wanted: dict[tuple[int, int], set[str]] = {}
    for n in map(ipaddress.ip_network, networks):
        text = f"{int(n.network_address):0{n.max_prefixlen // 4}x}"
        wanted.setdefault((n.version, n.prefixlen), set()).add(text[:-(-n.prefixlen // 4)])

    def inside(digits):
        hit = F.lit(False)
        for (version, bits), prefixes in sorted(wanted.items()):
            hit = hit | ((F.substring(digits, 1, 1) == str(version)) & prefix(digits, bits).isin(*sorted(prefixes)))
        return hit

    return F.coalesce(_bound(address_digits(address), inside), F.lit(False))


def longest_match(addresses: DataFrame, networks: DataFrame, address_col: str, out_col: str,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out_col``: the row (a struct, with ``bits``) of the most specific network
    that each address lies in, NULL if none.

    ``networks``: the columns of ``parse_networks``, each network once."""
    attributes = [c for c in networks.columns if c not in ("family", "prefix")]
    keyed = networks.select(F.concat_ws("/", "family", "bits", "prefix").alias("__net"), "family", "bits",
                            F.struct(*attributes).alias("__row"))
    table = materialise(keyed)
    lengths = [(r["family"], r["bits"]) for r in
               table.df.groupBy("family", "bits").count().orderBy("family", F.desc("bits")).collect()]
    # Strings of a struct are not in the measured bytes: a bound on rows alone.
    small = table.rows <= max_broadcast_rows
    out = addresses.withColumn("__digits", address_digits(F.col(f"`{address_col}`")))
    matches = []
    for k, (family, bits) in enumerate(lengths):
        key = F.when(F.substring("__digits", 1, 1) == str(family),
                     F.concat(F.lit(f"{family}/{bits}/"), prefix(F.col("__digits"), bits)))
        # The same plan on the build side of every length: one broadcast, reused.
        side = table.df if small else table.df.where((F.col("family") == family) & (F.col("bits") == bits))
        if small or bits <= SHORT_BITS or side.count() <= max_broadcast_rows:
            side = F.broadcast(side)
        side = side.select(F.col("__net").alias(f"__net{k}"), F.col("__row").alias(f"__row{k}"))
        out = out.withColumn(f"__key{k}", key).join(side, F.col(f"__key{k}") == F.col(f"__net{k}"), "left").drop(
            f"__key{k}", f"__net{k}")
        matches.append(f"__row{k}")
    empty = F.lit(None).cast(keyed.schema["__row"].dataType)
    found = F.coalesce(*matches, empty) if matches else empty
    return out.withColumn(out_col, found).drop("__digits", *matches)
