"""Documents that no operator may stumble over, and small helpers."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import types as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: Columns besides doc_id and text have names that the operators use themselves.
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("score", "n_words", "h1", "batch", "kept")]
    + [T.StructField(c, T.LongType()) for c in ("component_id", "n", "grp", "n_chars")]
)

_LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
_BODY = " ".join(f"body{k}" for k in range(80))

#: (doc_id, text): nulls, empty and white texts, one word, a very long text, copies, near
#: copies, rows repeated in full, rows without id, characters beyond ASCII.
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "one"),
    (5, _LONG),
    (6, _BODY),
    (7, _BODY + " end"),
    (7, _BODY + " end"),
    (8, _BODY),
    (9, "Ünï çödé Ωmega 日本 é\nline\n\n  LINE \r\nline"),
    (10, "the cat sat on the mat. " * 5),
    (11, "x" * 40_000),
    (None, _BODY),
    (None, None),
    (12, "one"),
    (-3, "before " + _BODY),
]


def documents(spark, texts=TEXTS):
    rows = [(d, t, "s", "n", "h", "b", "k", 1, 2, 3, 4) for d, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def lower(text: str | None) -> bytes:
    """A-Z in lower case."""
    return (text or "").encode().lower()


def by_key(df, *columns):
    """Sorted tuples, nulls too."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
