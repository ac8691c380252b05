"""Secret scan: fixed shapes, and incompressible strings in sensitive places.

A candidate in a sensitive context is weighed by the bytes it adds to its own surroundings in a
zstandard frame primed with common identifiers: text and identifiers repeat what the dictionary or
the context holds and cost little; a key costs nearly its whole length. The measure alone decides, whatever
letters and digits a run has.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The shapes of the base kinds, in order of kind.
ASSIGN = r'''(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)'''
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "novel")

#: Words that make the text after them a sensitive place.
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "apikey", "api-key",
             "access_key", "private_key", "credential", "credentials", "authorization", "bearer", "signature")

#: What code around keys is made of; primes the compressor.
IDENTIFIERS = " ".join("""
    import from return const static public private class function def self this null none true false export
    config settings environment production development staging database connection connectionString username
    hostname localhost example.com http:// https:// version default value string number boolean object array
    client server request response header content-type application/json Authorization: Bearer access_token
    refresh_token client_id client_secret api_key apiKey API_KEY secret_key SECRET_KEY private_key PRIVATE_KEY
    password= PASSWORD= passwd= token= TOKEN= aws_access_key_id aws_secret_access_key session_id signature
    test_token dummy_password changeme placeholder your_api_key_here xxxxxxxxxxxxxxxx 0000000000000000
    1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdef deadbeef localhost:8080
""".split())

SPANS = "array<struct<kind:string,start:int,end:int,novelty:double>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))


class Scanner:
    """``reach``: characters after a sensitive word that are its context; ``least``: a candidate's
    shortest length; ``novelty``: bytes it must add for each of its own; ``around``: characters before and
    behind it that it is weighed against, enough for the compressor to know the text's letters."""

    def __init__(self, reach: int = 80, least: int = 12, novelty: float = 0.76, around: tuple[int, int] = (1024, 512)):
        self.reach, self.least, self.novelty, self.around = reach, least, novelty, around
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(r"[0-9a-f]{32,}")  # the runs of HEX that are long enough
        self.sensitive = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
        self.candidate = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{least},}}")
        self.packer = zstandard.ZstdCompressor(level=19, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def base(self, text: str, lower: str) -> list[tuple]:
        out = []
        if any(w in lower for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
            out += [("assign", m.start(), m.end(), None) for m in self.assign.finditer(text) if len(m[2]) >= 8]
        if "AKIA" in text:
            out += [("access", m.start(), m.end(), None) for m in self.access.finditer(text) if m.end() - m.start() >= 16]
        return out + [("hex", m.start(), m.end(), None) for m in self.hex.finditer(text)]

    def marginal(self, before: str, candidate: str, after: str) -> float:
        """Bytes the candidate adds to its surroundings, for each of its own."""
        around = len(self.packer.compress((before + after).encode("utf-8", "replace")))
        with_it = len(self.packer.compress((before + after + candidate).encode("utf-8", "replace")))
        return (with_it - around) / len(candidate)

    def novel(self, text: str, lower: str, taken: list[tuple]) -> list[tuple]:
        if not any(w in lower for w in SENSITIVE):
            return []
        out, done, busy, k = [], 0, sorted(x[1:3] for x in taken), 0
        for word in self.sensitive.finditer(text):
            # A candidate begins within the reach; its shortest length may stand out of it.
            last = min(word.end() + self.reach + self.least - 1, len(text))
            for m in self.candidate.finditer(text, max(word.end(), done), last):
                start, end = m.span()
                if end == last and (more := self.candidate.match(text, start)):
                    end = more.end()  # the run goes on beyond the context
                if start < done:
                    continue
                done = end
                while k < len(busy) and busy[k][1] <= start:
                    k += 1
                found = text[start:end].rstrip(".")  # the full stop of a sentence
                end = start + len(found)
                if len(found) < self.least or any(a < end and start < b for a, b in busy[k : k + 4]):
                    continue
                # Copies of the candidate around it do not make it less of a secret.
                before, after = text[max(0, start - self.around[0]) : start], text[end : end + self.around[1]]
                score = self.marginal(before.replace(found, " "), found, after.replace(found, " "))
                if score >= self.novelty:
                    out.append(("novel", start, end, score))
        return out

    def spans(self, text: str | None) -> list[tuple]:
        """Base spans first found, then novel ones, by start and kind; null is the empty text."""
        if not text:
            return []
        lower = text.lower()
        found = self.base(text, lower)
        found += self.novel(text, lower, found)
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def secret_spans(text: Column, **limits) -> Column:
    """Array of ``(kind, start, end, novelty)`` in code points, end exclusive, by start and kind."""

    @F.arrow_udf(SPANS)
    def spans(column: pa.Array) -> pa.Array:
        scanner = Scanner(**limits)
        return pa.array([[dict(zip(("kind", "start", "end", "novelty"), x)) for x in scanner.spans(t)]
                         for t in column.to_pylist()], _TYPE)

    return spans(text)


def scan_secrets(df: DataFrame, text: str = "text", into: str = "secrets", **limits) -> DataFrame:
    """Adds ``into``, the spans of each row's whole text with what they hold.

    Null and empty texts have none; repeated rows are scanned each; other columns, also null ones,
    stay as they are, and a column that is already called ``into`` is replaced.
    """
    found = secret_spans(F.col(text), **limits)
    return df.withColumn(into, found).withColumn(into, F.transform(into, lambda s: s.withField(
        "value", F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]))))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
