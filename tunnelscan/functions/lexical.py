"""The thirteen lexical features as column expressions (O-41..O-53).

Eleven are native expressions.  The two entropy features default to an
Arrow-batched numpy UDF (``entropy_impl="arrow"``, see ``entropy_arrow``,
measured faster); ``entropy_impl="native"`` keeps them in higher-order
functions (``entropy`` below).  Both give the same values.

Semantics kept from the reference (SURVEY 1.4):

* D1: the "subdomain" is the name with every ``<domain>.`` removed, case
  sensitively; without a trailing dot nothing is removed.
* D2: splitting on ``.`` keeps the empty label after a trailing dot.
* D3: ``label_count`` counts dots.
* D5: a NULL domain or answer array gives NULL features; a NULL answer item
  gives NULL means (``max`` skips it); an empty answer item gives NULL shares.
* D6: no division can raise under ANSI mode.
* D7: entropy is never ``-0.0``.
* D8: "uppercase" is ``\\p{IsUppercase}``, "digit" is ``\\p{Nd}``; they are
  counted by deleting runs of other characters (``[^...]+``: one regex match
  per run, not per character).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = r"[^\p{IsUppercase}]+"
_DIGIT = r"[^\p{Nd}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_text(s) -> Column:
    """The string with invalid UTF-8 bytes replaced: DNS names and answers hold
    raw bytes, which Arrow rejects and which make no characters."""
    return F.make_valid_utf8(_col(s))


def upper_count(s) -> Column:
    return F.length(F.regexp_replace(_col(s), _UPPER, ""))


def digit_count(s) -> Column:
    return F.length(F.regexp_replace(_col(s), _DIGIT, ""))


def entropy(s) -> Column:
    """Shannon entropy (base 2) of the characters of ``s``; 0 for ''.

    Counts first: H = log2(n) - sum(c * log2(c)) / n over the per-character
    counts c, each taken as n - length(replace(s, ch, '')).
    """
    s = valid_text(s)
    n = F.length(s)
    distinct = F.array_distinct(F.split(s, ""))
    counts = F.transform(distinct, lambda ch: n - F.length(F.replace(s, ch, F.lit(""))))
    weighted = F.aggregate(counts, F.lit(0.0).cast("double"), lambda acc, c: acc + c * F.log2(c))
    return (
        F.when(n.isNull(), F.lit(None).cast("double"))
        .when(F.size(distinct) <= 1, F.lit(0.0))
        .otherwise(F.abs(F.log2(n) - weighted / n))
    )


def subdomain(qname, domain) -> Column:
    """D1: remove every ``<domain>.`` from the name (case sensitive)."""
    return F.replace(_col(qname), F.concat(_col(domain), F.lit(".")), F.lit(""))


def _entropy_fn(impl: str):
    if impl == "native":
        return entropy
    if impl == "arrow":
        from tunnelscan.functions.entropy_arrow import entropy_arrow
        return entropy_arrow
    raise ValueError(f"unknown entropy implementation {impl!r}")


def name_features(sub, entropy_impl: str = "arrow") -> dict[str, Column]:
    """O-41..O-48 from an already computed subdomain column ``sub``.

    ``entropy_impl``: ``native`` (higher-order functions, JVM) or ``arrow``
    (numpy over Arrow batches, see ``entropy_arrow``); equal results.
    """
    x = _col(sub)
    n = F.length(x)
    dots = n - F.length(F.replace(x, F.lit("."), F.lit("")))
    lens = F.transform(F.split(x, r"\.", -1), lambda p: F.length(p))
    # Labels are x split on every dot: their lengths sum to n - dots and
    # there are dots + 1 of them, so the mean needs no pass over the labels.

    def empty_zero(expr: Column) -> Column:
        return F.when(n.isNull(), F.lit(None).cast("double")).when(n == 0, F.lit(0.0)).otherwise(expr)

    return {
        "subdomain_length": n.cast("int"),
        "subdomain_entropy": _entropy_fn(entropy_impl)(x),
        "average_subdomain_length": empty_zero((n - dots) / (dots + 1)),
        "min_subdomain_length": empty_zero(F.array_min(lens).cast("double")),
        "max_subdomain_length": empty_zero(F.array_max(lens).cast("double")),
        "label_count": dots.cast("int"),
        "subdomain_uppercase_char": empty_zero(upper_count(x) / n),
        "subdomain_numeric_char": empty_zero(digit_count(x) / n),
    }


def answer_array(rdata, mode: str = "array", delimiter: str | None = None,
                 is_array: bool = True) -> Column:
    """Bring RDATA to ``array<string>`` (D4).

    ``mode='array'``: an array is used as is; a string is split on
    ``delimiter`` (or taken as a single item when no delimiter is given).
    ``mode='chars'``: a string is taken character by character, as the
    reference's training job does.
    """
    r = _col(rdata)
    if mode == "chars":
        # split('', '') is [''] in Spark; the characters of '' are none.
        return F.when(F.length(r) == 0, F.array().cast("array<string>")).otherwise(F.split(r, ""))
    if mode != "array":
        raise ValueError(f"unknown rdata mode {mode!r}")
    if is_array:
        return r
    if delimiter is None:
        return F.when(r.isNull(), F.lit(None)).otherwise(F.array(r))
    import re
    return F.split(r, re.escape(delimiter), -1)


def answer_features(arr, entropy_impl: str = "arrow") -> dict[str, Column]:
    """O-49..O-53 over an ``array<string>`` of answer items."""
    a = _col(arr)
    size = F.size(a)

    def per_array(expr: Column) -> Column:
        return (F.when(a.isNull(), F.lit(None).cast("double"))
                .when(size == 0, F.lit(0.0))
                .otherwise(expr))

    def mean_of(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, v: acc + v) / size

    def share(count_fn):
        return F.transform(a, lambda i: F.when(F.length(i) > 0, count_fn(i) / F.length(i)))

    return {
        # Sum of item lengths = length of their concatenation (NULL if any
        # item is NULL: array_join would skip it).
        "average_answer_length": per_array(
            F.when(F.size(F.array_compact(a)) == size, F.length(F.array_join(a, "")) / size)),
        "max_answer_length": per_array(F.array_max(F.transform(a, lambda i: F.length(i))).cast("double")),
        "average_answer_uppercase_char": per_array(mean_of(share(upper_count))),
        "average_answer_numeric_char": per_array(mean_of(share(digit_count))),
        "average_answer_entropy": (
            per_array(mean_of(F.transform(a, lambda i: entropy(i)))) if entropy_impl == "native"
            else _mean_item_entropy(a, entropy_impl)),
    }


def _mean_item_entropy(a: Column, impl: str) -> Column:
    if impl != "arrow":
        raise ValueError(f"unknown entropy implementation {impl!r}")
    from tunnelscan.functions.entropy_arrow import mean_item_entropy_arrow
    return mean_item_entropy_arrow(F.transform(a, lambda i: F.make_valid_utf8(i)))


def char_answer_features(s) -> dict[str, Column]:
    """O-49..O-53 in ``chars`` mode, in closed form on the string itself.

    Equal to ``answer_features(split(s, ''))``: every item is one character,
    so lengths are 1, item entropies 0, and the shares are whole-string shares.
    """
    s = _col(s)
    n = F.length(s)

    def per_string(expr: Column) -> Column:
        return (F.when(s.isNull(), F.lit(None).cast("double"))
                .when(n == 0, F.lit(0.0))
                .otherwise(expr))

    return {
        "average_answer_length": per_string(F.lit(1.0)),
        "max_answer_length": per_string(F.lit(1.0)),
        "average_answer_uppercase_char": per_string(upper_count(s) / n),
        "average_answer_numeric_char": per_string(digit_count(s) / n),
        "average_answer_entropy": per_string(F.lit(0.0)),
    }
