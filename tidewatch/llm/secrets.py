"""Secret scans: fixed patterns, and a randomness test battery over all other key-like tokens of a text.

1. Fixed patterns give the base spans, which always stay.
2. Tokens of key characters outside them get an inferred encoding (hex, base32, base36, base62, base64) and three tests of a
   uniform source: chi-squared over the alphabet, runs above and below the alphabet's middle, and serial correlation of
   neighbours. A token that a uniform source would hardly give is no candidate.
3. For the rest, the false-discovery side: how likely ordinary text of this length gives so even an alphabet. Its
   chi-squared statistic is a noncentral one whose noncentrality is proportional to the length, so short tokens need to be
   much more even. Ordinary use of ten digits and six letters is nearly even, so for hex, also in parts joined by dashes,
   it is how likely all letters of an ordinary token are among these six; digits say nothing there. A step-up rule over the
   probabilities of all tokens of all documents bounds the expected share of ordinary tokens among the reported ones. The
   rule needs counts in fixed bins only.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import pinned

# fixed values: the patterns of base spans, in the order of their kinds
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "random")

KEY_CHARACTERS = r"[A-Za-z0-9+/_=-]+"
# name, characters, symbols: the first alphabet that holds a token is inferred
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("hex", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base32", "abcdefghijklmnopqrstuvwxyz234567"), ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
SPAN = "struct<kind:string,start:int,end:int,bin:int>"
SCHEMA = f"doc_id long, spans array<{SPAN}>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32())]))


@dataclass(frozen=True)
class Options:
    """min_length: of a candidate; alpha: level of the three uniformity tests together; repeat_share: chance that two
    letters of ordinary text are equal; hex_share: chance that one is among A-F; discovery_rate: expected share of ordinary tokens
    among those reported; bins: steps of log10 probability, a tenth each."""

    min_length: int = 20
    alpha: float = 0.001
    repeat_share: float = 0.065
    hex_share: float = 0.32
    discovery_rate: float = 0.01
    bins: int = 400


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and not overlapping in each kind, by start and then kind."""
    spans = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        spans += [("assign", *m.span()) for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]{24,}", text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_tail(x: float, freedom: float) -> float:
    """Upper tail by the cube-root normal approximation."""
    s = 2 / (9 * freedom)
    return normal_tail(((max(x, 0.0) / freedom) ** (1 / 3) - (1 - s)) / math.sqrt(s))


def noncentral_lower_tail(x: float, freedom: float, shift: float) -> float:
    """P(noncentral chi-squared <= x) by the power normal approximation of its first three moments."""
    h = 1 - 2 * (freedom + shift) * (freedom + 3 * shift) / (3 * (freedom + 2 * shift) ** 2)
    p = (freedom + 2 * shift) / (freedom + shift) ** 2
    m = (h - 1) * (1 - 3 * h)
    mean = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    return normal_tail(-(((max(x, 1e-9) / (freedom + shift)) ** h - mean) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p))))


def symbols_of(token: str) -> str:
    """The token without padding and, where only hex symbols are left then, without separators."""
    body = token.rstrip("=")
    bare = body.replace("-", "").replace("_", "")
    return bare if any(set(bare) <= set(letters) for name, letters in ENCODINGS if name == "hex") else body


def inferred(token: str) -> tuple[str, str] | None:
    body = symbols_of(token)
    characters = set(body)
    return next(((name, letters) for name, letters in ENCODINGS if characters <= set(letters)), None)


def uniformity(token: str, alphabet: str) -> tuple[float, float, float, float]:
    """(chi-squared statistic, its p, p of the runs test, p of the serial correlation) of a token's symbols."""
    place = {c: k for k, c in enumerate(alphabet)}
    x = np.array([place[c] for c in token], dtype=float)
    n, k = len(x), len(alphabet)
    counts = np.bincount(x.astype(int), minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    high = x >= k / 2
    above, below = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if above and below:
        mean = 1 + 2 * above * below / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * normal_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    spread = x.var()
    serial = float(((x[1:] - x.mean()) * (x[:-1] - x.mean())).mean() / spread) if spread > 0 else 1.0
    p_serial = 2 * normal_tail(abs(serial * math.sqrt(n) + 1 / math.sqrt(n)))
    return chi, chi_squared_tail(chi, k - 1), min(1.0, p_runs), min(1.0, p_serial)


def ordinary_probability(token: str, options: Options) -> float:
    """How likely ordinary text gives a token as even as this one; 1 for tokens that no uniform source gives."""
    encoding = inferred(token)
    body = symbols_of(token)
    if encoding is None or len(body) < options.min_length:
        return 1.0
    alphabet = encoding[1]
    chi, *tests = uniformity(body, alphabet)
    if min(tests) * len(tests) < options.alpha:
        return 1.0
    least = 10.0 ** (-options.bins / 10)
    if encoding[0] == "hex":
        return max(options.hex_share ** sum(c.isalpha() for c in body), least)
    shift = len(body) * (len(alphabet) * options.repeat_share - 1)
    if shift <= 0:  # ordinary text is as even
        return 1.0
    return min(1.0, max(noncentral_lower_tail(chi, len(alphabet) - 1, shift), least))


def scan(text: str, options: Options) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, bin) of base spans (bin -1) and of the tested tokens outside them, by start and kind."""
    base = base_spans(text)
    spans = [(*s, -1) for s in base]
    # tokens come in order too: of the base spans only those from `at` on can still overlap one
    ordered, at = sorted((s, e) for _, s, e in base), 0
    ends = list(itertools.accumulate((e for _, e in ordered), max))
    for word in re.finditer(rf"\S{{{options.min_length},}}", text):
        for m in re.finditer(KEY_CHARACTERS, word.group()):
            start, end = m.start() + word.start(), m.end() + word.start()
            while at < len(ends) and ends[at] <= start:
                at += 1
            if end - start < options.min_length or (at < len(ends) and ordered[at][0] < end):
                continue
            p = ordinary_probability(m.group(), options)
            spans.append(("random", start, end, min(options.bins, math.floor(-10 * math.log10(p)))))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scanned(options: Options):
    def scan_batches(batches):
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e, "bin": b} for k, s, e, b in scan(t.as_py() or "", options)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "spans": pa.array(found, _SPANS)})
    return scan_batches


def threshold(counts: dict[int, int], options: Options) -> int:
    """The lowest bin reported: the step-up rule over bins, each taken at its largest probability."""
    total, seen, found = sum(counts.values()), 0, options.bins + 1
    for k in range(options.bins, -1, -1):
        seen += counts.get(k, 0)
        if seen and 10.0 ** (-k / 10) * total <= options.discovery_rate * seen:
            found = k
    return found


def secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", options: Options = Options()) -> DataFrame:
    """(doc_id, spans) for every row: (kind, start, end, bin) of each secret, in code points, end exclusive.

    Null and empty texts have none. Repeated rows are tested one by one; an empty table gives no rows; other columns are
    ignored. Texts are scanned once; the written spans are small, and the counts of their bins are at most `bins` + 1 rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("body"))
    found = pinned(rows.mapInArrow(_scanned(options), SCHEMA))
    bins = (found.select(F.explode("spans").alias("s")).where("s.kind = 'random'")
            .groupBy(F.col("s.bin").alias("bin")).agg(F.count("*").alias("n")))
    lowest = threshold({r.bin: r.n for r in bins.collect()}, options)
    return found.select("doc_id", F.filter("spans", lambda s: (s["kind"] != "random") | (s["bin"] >= lowest)).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of what `secrets` found."""

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def redacted(text: str, spans: list[tuple[int, int]], mask: str = "[secret]") -> str:
    """The text with each span replaced; overlapping spans are one."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]
