"""Secrets in texts: three fixed patterns, and random strings by token efficiency.

Fixed patterns (``assign``, ``access``, ``hex``) are leftmost and
non-overlapping per kind; a match that is too short is dropped.  The method adds
kind ``random``: 16 or more of ``[A-Za-z0-9+/_=-]`` with a letter that the fixed
patterns left alone and that a byte-pair vocabulary compresses badly (fewer than
2.0 characters a token; letters of one case are read in lower case).  A run is
tested as a whole and, if that finds nothing, without the words at its ends and
part by part between separators.  Known digests and identifiers are excluded:
hexadecimal of a digest's length, UUIDs, dates and numbers with separators,
parts of e-mail addresses, and names with separators whose parts are words that
the vocabulary compresses well.

Scale: one pass, no shuffle; the vocabulary (under 1 MB, a public file of fixed
size) is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.llm.common import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "random")
MIN_RUN, MAX_CHARS_PER_TOKEN = 16, 2.0

# The three base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
NUMBER = re.compile(r"[0-9TZ+/_=-]+")
NAME = re.compile(r"(?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,8})(?:[/_=+-]+(?:[A-Za-z]{2,}[0-9]{0,4}|[A-Za-z]|[0-9]{1,8}))*[/_=+-]*")


#: Separators at which a run is parted, coarse to fine.
SEPARATORS = (re.compile(r"=+"), re.compile(r"/+"), re.compile(r"[_-]+"), re.compile(r"\++"))
PART = re.compile(r"[A-Za-z0-9]+")


def is_dense(run: str, tokens) -> bool:
    """Fewer characters a token than words have."""
    n = tokens(run)
    if run.isupper() and run.isalpha():
        n = min(n, tokens(run.lower()))
    return len(run) < MAX_CHARS_PER_TOKEN * n


def is_word(part: str, tokens) -> bool:
    """Short, a number, or letters that compress well before at most four digits."""
    letters = part.rstrip("0123456789")
    return not letters or len(letters) < 6 and len(part) < 10 or letters.isalpha() and not is_dense(letters, tokens)


def is_known(run: str, tokens) -> bool:
    """A digest, UUID, number, or name of several words."""
    if not any(c.isalpha() for c in run):
        return True
    bare = run.strip("=+/_-")
    if DIGEST.fullmatch(bare) and len(bare) in DIGEST_LENGTHS:
        return True
    if UUID.fullmatch(bare) or NUMBER.fullmatch(bare):
        return True
    parts = PART.findall(run)
    return (len(parts) > 1 and bool(NAME.fullmatch(run)) and not re.search(r"[a-z][A-Z]{1,3}[a-z]{1,2}[A-Z]", run)
            and all(is_word(p, tokens) for p in parts))


def random_parts(run: str, at: int, tokens, level: int = 0) -> list[tuple[int, int]]:
    """Spans of the random strings of a run that stands at ``at``."""
    if len(run) < MIN_RUN or is_known(run, tokens):
        return []
    if is_dense(run, tokens):
        return [(at, at + len(run))]
    out = []
    if level == 0:  # without the words at its ends
        parts = list(PART.finditer(run))
        other = [m for m in parts if not is_word(m[0], tokens)]
        if other and (other[0] is not parts[0] or other[-1] is not parts[-1]):
            a, b = other[0].start(), other[-1].end()
            if b - a >= MIN_RUN and not is_known(run[a:b], tokens) and is_dense(run[a:b], tokens):
                return [(at + a, at + b)]
    while level < len(SEPARATORS) and not SEPARATORS[level].search(run):
        level += 1
    if level < len(SEPARATORS):
        a = 0
        for m in [*SEPARATORS[level].finditer(run), None]:
            b = m.start() if m else len(run)
            out += random_parts(run[a:b], at + a, tokens, level + 1)
            a = m.end() if m else b
    return out


def find(text: str, tokens) -> list[tuple[int, int, str]]:
    """Spans ``(start, end, kind)`` of a text by start, then kind; ``tokens``
    gives the number of tokens of a run."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base = list(out)
    for m in RUN.finditer(text):
        a, b = m.span()
        if text[a - 1:a] in ("@", "%") or text[b:b + 1] == "@":  # part of an address
            continue
        # What the fixed patterns leave of the run.
        for x, y in [*sorted((x, y) for x, y, _ in base if x < b and a < y), (b, b)]:
            out += [(*s, "random") for s in random_parts(text[a:max(a, x)], a, tokens)]
            a = max(a, y)
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _counter(data: bytes):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    encoding = tiktoken.Encoding("runs", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return lambda run: len(encoding.encode_ordinary(run))


def _vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, spans)`` per row, ``spans`` an array of (start, end, kind) in code
    points, end exclusive.  A null or empty text has none; repeated rows are each
    returned; other columns are not read."""
    data = _vocabulary(docs, vocabulary)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        tokens = _counter(data.value)
        for batch in batches:
            for rows, _, _ in slices(batch, "text"):
                found = [[{"start": a, "end": b, "kind": k} for a, b, k in find(t or "", tokens)]
                         for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])))], ["doc_id", "spans"])
    return docs.mapInArrow(run, "doc_id long, spans array<struct<start:int,end:int,kind:string>>")


def digests(found: DataFrame) -> DataFrame:
    """The counts and digests of ``scan``."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [k for k in KINDS if k != "random"]
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        joined("spans").alias("spans"), count("random").alias("n_random"))


def redact(docs: DataFrame, mark: str = "[SECRET]", vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents with every found span replaced by ``mark`` (overlapping spans
    together); other rows and all other columns stay as they are, but for
    ``n_chars``, which follows the text where it is present."""
    data = _vocabulary(docs, vocabulary)
    columns, schema = docs.columns, StructType(
        [StructField(f.name, StringType()) if f.name == "text" else f for f in docs.schema.fields])

    def run(batches):
        tokens = _counter(data.value)
        for batch in batches:
            for rows, _, _ in slices(batch, "text"):
                texts = rows.column("text").to_pylist()
                for i, t in enumerate(texts):
                    if t:
                        out, at, end = [], 0, -1
                        for a, b, _ in find(t, tokens):
                            if a >= end:
                                out += [t[at:a], mark]
                            end = at = max(at, b)
                        texts[i] = "".join(out) + t[at:]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else rows.column(c)
                                                  for c in columns], columns)
    out = docs.mapInArrow(run, schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
