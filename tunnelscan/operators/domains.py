"""Registrable domain of a DNS name (O-14) and the reverse-lookup filter (O-15).

Public-suffix semantics over a rule table ``(suffix, kind)`` where kind is
``exact`` (``co.uk``), ``wildcard`` (``*.ck`` stored as ``ck``) or
``exception`` (``!www.ck`` stored as ``www.ck``):

1. one trailing dot is dropped and the name lower-cased, for matching only;
2. the candidate suffixes are the last k labels, k = 1 .. depth of the rules;
3. an exception rule wins and its public suffix is the rule minus its
   leftmost label; otherwise the longest match wins, a wildcard matching one
   label more than its stem;
4. the registrable domain is the public suffix plus one label (no trailing
   dot); NULL if the name is itself a suffix or no rule matches.  With
   ``fallback_last_label`` the last label acts as the suffix where no rule
   matches.  That is the default for the short built-in list, so that names
   under an unlisted suffix are judged and not lost; a user's table is taken
   as complete;
5. rules in Unicode are coded (``xn--…``) when they are read, and so are, for
   matching, the labels of names in Unicode where any rule is coded.  The result
   has the labels as the name has them (``functions.idn.ascii_name`` codes names
   beforehand, which makes one domain of both spellings).

Plan: the rule table is small and its size is checked, so each candidate depth
is one broadcast hash join against it.  Rows never leave their partition: no
shuffle, no distinct, no join back of the wide message rows.  (A join-free variant
with ``isin`` sets was measured 3x slower inside real queries: Catalyst pushed
the later ``2ld`` filter below the projections by inlining the whole domain
expression, computing it twice per row; the joins act as a barrier.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.functions.idn import ascii_labels, plain_dots
from tunnelscan.schemas import SUFFIX_RULE_SCHEMA


# The short default rule list shipped with the repo (a full public
# suffix list is a user-given file, see read_suffix_rules).
DEFAULT_SUFFIX_RULES = (
    ("com", "exact"),
    ("net", "exact"),
    ("org", "exact"),
    ("uk", "exact"),
    ("co.uk", "exact"),
    ("arpa", "exact"),
    ("in-addr.arpa", "exact"),
    ("ck", "wildcard"),
    ("www.ck", "exception"),
)

# Rule tables larger than this are joined with a shuffle instead of a broadcast.
MAX_BROADCAST_RULES = 2_000_000


def rules_from_pairs(spark: SparkSession, pairs) -> DataFrame:
    """A small rule table as a JVM-side local relation (no Python round trip)."""
    rows = [F.struct(F.lit(s).alias("suffix"), F.lit(k).alias("kind")) for s, k in pairs]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def default_suffix_rules(spark: SparkSession) -> DataFrame:
    return rules_from_pairs(spark, DEFAULT_SUFFIX_RULES)


def _static_stats(pairs) -> tuple[int, int]:
    suffixes = {s.lower() for s, _ in pairs}
    return len(suffixes), max(len(s.split(".")) for s in suffixes)


def parse_suffix_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Public-suffix-list text (one rule per line, ``//`` comments) -> rules; any
    other columns (the section, say) stay."""
    rule = F.lower(F.trim(F.split(F.col(column), r"\s")[0]))
    others = [c for c in lines.columns if c != column]
    kept = lines.select(rule.alias("rule"), *others).where((F.col("rule") != "") & ~F.col("rule").startswith("//"))
    kind = (F.when(F.col("rule").startswith("!"), "exception")
            .when(F.col("rule").startswith("*."), "wildcard")
            .otherwise("exact"))
    suffix = (F.when(F.col("rule").startswith("!"), F.expr("substring(rule, 2)"))
              .when(F.col("rule").startswith("*."), F.expr("substring(rule, 3)"))
              .otherwise(F.col("rule")))
    return kept.select(suffix.alias("suffix"), kind.alias("kind"), *others)


# How the public list marks its sections.
_SECTION_MARK = r"(?m)^//\s*===\s*(?=(?:BEGIN|END) )"
_SECTION_OPENS = r"^BEGIN (\w+) DOMAINS"
_SECTION_LINE = r"^(BEGIN|END) \w+ DOMAINS"
PRIVATE_SECTION = "private"


def sectioned_lines(texts: DataFrame, column: str = "value") -> DataFrame:
    """Lines (``value``) of whole list texts with their ``section``: ``icann``,
    ``private``, another marked one, or NULL outside any."""
    parts = texts.select(F.explode(F.split(F.regexp_replace(column, "\r\n?", "\n"), _SECTION_MARK)).alias("part"))
    section = F.nullif(F.lower(F.regexp_extract("part", _SECTION_OPENS, 1)), F.lit(""))
    lines = parts.select(section.alias("section"), F.explode(F.split("part", "\n")).alias("value"))
    return lines.where(~F.col("value").rlike(_SECTION_LINE)).select("value", "section")


def read_suffix_rules(spark: SparkSession, path: str, private: bool = True) -> DataFrame:
    """The rules of a public-suffix-list file with the ``section`` they stand in;
    ``private=False`` leaves the rules of the private section out (names under
    ``blogspot.com`` then share the domain ``blogspot.com``)."""
    rules = parse_suffix_lines(sectioned_lines(spark.read.text(path, wholetext=True)))
    return rules if private else rules.where(F.coalesce(F.col("section"), F.lit("")) != PRIVATE_SECTION)


def _flag_table(rules: DataFrame) -> DataFrame:
    """One row per suffix, coded, with its three kind flags (unique join key)."""
    labels = F.split(plain_dots(F.lower(F.col("suffix"))), r"\.", -1)
    return (rules.select(F.array_join(ascii_labels(labels), ".").alias("suffix"), "kind")
            .groupBy("suffix")
            .agg(F.max((F.col("kind") == "exact").cast("int")).alias("e"),
                 F.max((F.col("kind") == "wildcard").cast("int")).alias("w"),
                 F.max((F.col("kind") == "exception").cast("int")).alias("x")))


def _static_flag_table(spark: SparkSession, pairs) -> DataFrame:
    """The flag table of a short literal rule list, built on the driver."""
    flags: dict[str, list[int]] = {}
    for suffix, kind in pairs:
        f = flags.setdefault(suffix.lower(), [0, 0, 0])
        f[("exact", "wildcard", "exception").index(kind)] = 1
    rows = [F.struct(F.lit(s).alias("suffix"), F.lit(e).alias("e"), F.lit(w).alias("w"), F.lit(x).alias("x"))
            for s, (e, w, x) in flags.items()]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Suffixes:
    """A rule table made ready for matching: one row of flags for each suffix."""

    flags: DataFrame
    rows: int
    depth: int          # labels of the longest suffix
    coded: bool         # whether any label of a suffix is coded
    complete: bool      # a user's table, not the short built-in one


def suffix_table(spark: SparkSession, rules: DataFrame | Suffixes | None = None) -> Suffixes:
    """A user-given table is aggregated once and written to the shared checkpoint
    folder; every candidate depth then joins that same small table.
    """
    if isinstance(rules, Suffixes):
        return rules
    if rules is None:
        n_rules, depth = _static_stats(DEFAULT_SUFFIX_RULES)
        return Suffixes(_static_flag_table(spark, DEFAULT_SUFFIX_RULES), n_rules, depth, False, False)
    missing = [f.name for f in SUFFIX_RULE_SCHEMA.fields if f.name not in rules.columns]
    if missing:
        raise ValueError(f"suffix rules lack columns {missing}")
    flags = _flag_table(rules).checkpoint(eager=True)
    stats = flags.agg(F.count(F.lit(1)).alias("n"),
                      F.max(F.size(F.split("suffix", r"\."))).alias("depth"),
                      F.coalesce(F.bool_or(F.col("suffix").contains("xn--")), F.lit(False)).alias("coded")).first()
    return Suffixes(flags, int(stats["n"]), int(stats["depth"] or 0), stats["coded"], True)


def registrable_domain(df: DataFrame, name_col: str, rules: DataFrame | Suffixes | None = None,
                       out_col: str = "2ld", fallback_last_label: bool | None = None,
                       preserve_case: bool = False) -> DataFrame:
    """Add ``out_col``: the registrable domain of ``name_col``.

    ``fallback_last_label=None`` means: only with the built-in rules."""
    suffixes = suffix_table(df.sparkSession, rules)
    flags, depth, coded = suffixes.flags, suffixes.depth, suffixes.coded
    if fallback_last_label is None:
        fallback_last_label = not suffixes.complete
    # The same plan on the build side at every depth: one broadcast, reused.
    tmp = "__sfx"
    flags = flags.select(*[F.col(c).alias(f"{tmp}_{c}") for c in ("suffix", "e", "w", "x")])
    side = F.broadcast(flags) if suffixes.rows <= MAX_BROADCAST_RULES else flags

    name = plain_dots(F.col(name_col)) if coded else F.col(name_col)
    # Drop one trailing dot (no regex: endswith + substring).
    stripped = F.when(name.endswith("."), name.substr(F.lit(1), F.length(name) - 1)).otherwise(name)
    out = df.withColumn(f"{tmp}_name", stripped)
    out = out.withColumn(f"{tmp}_labels", F.split(F.lower(F.col(f"{tmp}_name")), r"\.", -1))
    if coded:
        # Matched in coded form; the result is cut from the labels as they were.
        out = out.withColumn(f"{tmp}_plain", F.col(f"{tmp}_labels")).withColumn(
            f"{tmp}_labels", ascii_labels(F.col(f"{tmp}_plain")))
    if preserve_case:
        out = out.withColumn(f"{tmp}_orig", F.split(F.col(f"{tmp}_name"), r"\.", -1))
    labels = F.col(f"{tmp}_labels")
    n = F.size(labels)

    exception_len, exact_len, wild_len = [], [], []
    for k in range(1, depth + 1):
        r = f"{tmp}_r{k}"
        cand = F.when(n >= k, F.array_join(F.slice(labels, -k, k), "."))
        keep = [F.col(f"`{c}`") for c in out.columns]
        out = (out.withColumn(f"{tmp}_c{k}", cand)
               .join(side.alias(r), F.col(f"{tmp}_c{k}") == F.col(f"{r}.{tmp}_suffix"), "left")
               .select(*keep, F.col(f"{r}.{tmp}_e").alias(f"{tmp}_e{k}"),
                       F.col(f"{r}.{tmp}_w").alias(f"{tmp}_w{k}"), F.col(f"{r}.{tmp}_x").alias(f"{tmp}_x{k}")))
        exception_len.append(F.when(F.col(f"{tmp}_x{k}") == 1, F.lit(k - 1)))
        exact_len.append(F.when(F.col(f"{tmp}_e{k}") == 1, F.lit(k)))
        wild_len.append(F.when((F.col(f"{tmp}_w{k}") == 1) & (n >= k + 1), F.lit(k + 1)))

    def greatest(cols: list[Column]) -> Column:
        return F.greatest(*cols) if len(cols) > 1 else (cols[0] if cols else F.lit(None).cast("int"))

    suffix_len = F.coalesce(greatest(exception_len), greatest(exact_len + wild_len))
    if fallback_last_label:
        suffix_len = F.coalesce(suffix_len, F.lit(1))
    out = out.withColumn(f"{tmp}_len", suffix_len)
    src = F.col(f"{tmp}_orig" if preserve_case else f"{tmp}_plain" if coded else f"{tmp}_labels")
    take = F.col(f"{tmp}_len") + 1
    # A name whose labels are all empty ("", ".") has no registrable domain.
    result = F.when((F.col(f"{tmp}_len").isNotNull()) & (n >= take) & (F.col(f"{tmp}_name") != ""),
                    F.array_join(F.slice(src, -take, take), "."))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], result.alias(out_col))


def is_forward(domain_col: str = "2ld") -> Column:
    """Whether a domain is none of reverse lookups; NULL for no domain (D9)."""
    return ~F.col(domain_col).endswith("in-addr.arpa")


def drop_reverse_lookups(df: DataFrame, domain_col: str = "2ld") -> DataFrame:
    """O-15: ``NOT endswith(domain, 'in-addr.arpa')``; NULL domains drop too (D9)."""
    return df.where(is_forward(domain_col))
