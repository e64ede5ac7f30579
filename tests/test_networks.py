import ipaddress
import random

import pytest
from pyspark.sql import functions as F
from support import explain

from tunnelscan.operators import networks as N

ODD = ["10.0.0.1", "::1", "::", "2001:db8::", "2001:DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "fe80::1%eth0", "::ffff:10.0.0.1",
       "64:ff9b::192.0.2.33", "1::8", "255.255.255.255", "0.0.0.0"]
BAD = ["", " ", "10.0.0", "10.0.0.256", "10.0.0.1.2", "010.0.0.1", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "12345::",
       "g::1", "::10.0.0.300", "1:2:3:4:5:6:7::8", "hello", None, "1.2.3.4:53"]


def canonical(text):
    """Python's own reading: family and hex digits."""
    try:
        ip = ipaddress.ip_address((text or "").strip().split("%")[0])
    except ValueError:
        return None
    ip = getattr(ip, "ipv4_mapped", None) or ip
    return f"{ip.version}{int(ip):0{ip.max_prefixlen // 4}x}"


def test_addresses_are_read_as_python_reads_them(spark):
    rng = random.Random(1)
    texts = ODD + BAD + [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(100)]
    for _ in range(300):
        ip = ipaddress.IPv6Address(rng.getrandbits(128) & rng.choice([-1, 0xFFFF << 64 | 0xFFFF, 0xFF << 96]))
        texts += [str(ip), ip.exploded.upper()]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "a string").select(N.address_digits(F.col("a"))).collect()]
    assert [(t, g) for t, g in zip(texts, got) if g != canonical(t)] == []


def brute(address, table):
    """Most specific network's length and name by Python's ``ipaddress``."""
    best = None
    if canonical(address) is None:
        return None
    ip = ipaddress.ip_address(address.split("%")[0])
    ip = getattr(ip, "ipv4_mapped", None) or ip
    for text, name in table:
        try:
            net = ipaddress.ip_network(text, strict=False)
        except (ValueError, TypeError):
            continue
        if net.version == ip.version and ip in net and (best is None or net.prefixlen > best[0]):
            best = (net.prefixlen, name)
    return best


@pytest.mark.parametrize("bound", [500_000, 3])
def test_longest_match_equals_brute_force(spark, bound):
    rng = random.Random(bound)
    table = {}
    for bits in list(range(0, 33, 3)) + [31, 32]:
        table[str(ipaddress.ip_network((0x0A000000 | rng.getrandbits(16), bits), strict=False))] = f"v4/{bits}"
    for bits in list(range(0, 129, 13)) + [127, 128]:
        table[str(ipaddress.ip_network((0x20010DB8 << 96 | rng.getrandbits(12), bits), strict=False))] = f"v6/{bits}"
    rows = list(table.items())
    given = [(n.upper(), name) for n, name in rows] + [("10.0.0.0/33", "bad"), ("10.0.0.0/-1", "bad"), ("::/129", "bad"),
                                                       ("10.0.0.0/8/8", "bad"), ("x/8", "bad"), (None, "bad"), ("10.0.0.0/", "bad")]
    nets = N.parse_networks(spark.createDataFrame(given, "network string, name string"))
    assert nets.count() == len(rows)
    addresses = ODD + BAD + [str(ipaddress.IPv4Address(0x0A000000 | rng.getrandbits(rng.choice([4, 12, 24])))) for _ in range(100)]
    addresses += [str(ipaddress.IPv6Address(0x20010DB8 << 96 | rng.getrandbits(rng.choice([4, 12, 90])))) for _ in range(100)]
    out = N.longest_match(spark.createDataFrame([(a,) for a in addresses], "a string"), nets, "a", "net", bound).collect()
    got = {r["a"]: None if r["net"] is None else (r["net"]["bits"], r["net"]["name"]) for r in out}
    assert len(out) == len(addresses)
    assert {a: (got[a], brute(a, rows)) for a in got if got[a] != brute(a, rows)} == {}


def test_mapped_networks_and_host_bits(spark):
    nets = N.parse_networks(spark.createDataFrame([("::ffff:10.0.0.0/104", "a"), ("192.168.1.77/24", "b"), ("fe80::1/10", "c")],
                                                  "network string, name string"))
    assert {(r["family"], r["bits"], r["prefix"], r["name"]) for r in nets.collect()} == {
        (4, 8, "0a", "a"), (4, 24, "c0a801", "b"), (6, 10, "fe8", "c")}


def test_private_side_of_both_families(spark):
    texts = ODD + BAD + ["10.255.0.1", "11.0.0.1", "172.15.0.1", "172.16.0.1", "172.31.255.255", "172.32.0.1", "192.168.4.4", "192.169.0.1",
                         "100.63.0.1", "100.64.0.1", "100.127.255.255", "100.128.0.1", "fc00::1", "fdff::1", "fe00::1", "fe80::2", "febf::",
                         "fec0::", "2001:db8::1", "8.8.8.8", "169.254.1.1", "127.0.0.53"]
    nets = [ipaddress.ip_network(n) for n in N.PRIVATE_NETWORKS]
    got = {r["a"]: r["p"] for r in spark.createDataFrame([(t,) for t in texts], "a string").select("a", N.in_networks(F.col("a")).alias("p")).collect()}
    for t in texts:
        digits = canonical(t)
        ip = digits and (ipaddress.IPv4Address if digits[0] == "4" else ipaddress.IPv6Address)(int(digits[1:], 16))
        assert got[t] == bool(ip and any(ip in n for n in nets if n.version == ip.version)), t


def test_matching_is_map_side_below_the_bound(spark):
    nets = N.parse_networks(spark.createDataFrame([("10.0.0.0/8", "a"), ("10.1.0.0/16", "b"), ("::/0", "c")], "network string, name string"))
    plan = explain(N.longest_match(spark.createDataFrame([("10.1.2.3",)], "a string"), nets, "a", "net"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert explain(N.longest_match(spark.createDataFrame([("10.1.2.3",)], "a string"), nets.limit(0), "a", "net"))
