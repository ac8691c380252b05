"""Code parsing, lookups in small fixed maps, and deterministic hashing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def mapped(value: Column, codes: Mapping, default) -> Column:
    """Literal map lookup; a miss or NULL gives ``default``."""
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(codes.items())])
    return F.coalesce(pairs[value], F.lit(default))


def icd_number(code: Column) -> Column:
    """Whole-number part of a numeric ICD-9 code; NULL for letter-prefixed codes."""
    head = F.substring_index(code, ".", 1)
    return F.when(head.rlike("^[0-9]+$"), head.try_cast("double"))


def band_midpoint(band: Column) -> Column:
    """Middle of a ``[a-b)`` band; a plain number is kept; anything else is NULL."""
    low = F.regexp_extract(band, r"^[\[(]?(\d+)-(\d+)[)\]]?$", 1).try_cast("double")
    high = F.regexp_extract(band, r"^[\[(]?(\d+)-(\d+)[)\]]?$", 2).try_cast("double")
    plain = F.regexp_extract(band, r"^[\[(>]*(\d+(?:\.\d+)?)[)\]]*$", 1).try_cast("double")
    return F.coalesce((low + high) / 2, plain)


def order_hash(*keys: Column, seed: int = 42) -> Column:
    """Hex digest that puts rows in a fixed pseudo-random order."""
    parts = [k.cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts))


def digest_mod(text: Column, modulus: int) -> Column:
    """md5 of ``text`` read as one 128-bit integer, modulo ``modulus``."""
    digest = F.md5(text)
    high = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(digest, 17, 16), 16, 10).cast("decimal(20,0)")
    step = (1 << 64) % modulus
    return ((high % modulus).cast("int") * step + (low % modulus).cast("int")) % modulus


def unit_interval(digest: Column) -> Column:
    """A number in ``[0, 1)`` from the first eight hex digits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def first_match(text: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]],
                fallback: str) -> Column:
    """Name of the first rule one of whose words occurs in ``text``.

    A rule is ``(name, any_of, all_of)``; matching is on lower-cased substrings.
    """
    lowered = F.lower(text)
    result = None
    for name, any_of, all_of in rules:
        hit = F.lit(False)
        for word in any_of:
            hit = hit | lowered.contains(word)
        for word in all_of:
            hit = hit & lowered.contains(word)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result.otherwise(fallback)
