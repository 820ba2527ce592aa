"""Token counts by a public tokenizer, whose file stays where it is and is named by a path."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern that comes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_FILE = "byte_bpe_50k.tiktoken"


def default_path() -> str:
    """The rank file in the folder that $ROSTRUM_TOKENIZERS names, else where the public files are installed."""
    folder = os.environ.get("ROSTRUM_TOKENIZERS", "/opt/tokenizers")
    if not os.path.isdir(folder) and (spec := importlib.util.find_spec("public_tokenizers")):
        folder = os.path.dirname(spec.origin or "")
    return os.path.join(folder, DEFAULT_FILE)


@lru_cache(4)
def encoder(path: str):
    """The tokenizer of a rank file; one per worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for b in batches:
            counts = [len(encode(x)) if x else 0 for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(counts, pa.int64())], names=[*b.schema.names[1:], "tokens"])

    return run


def token_counts(df: DataFrame, text_col: str, keep: dict[str, str], path: str | None = None) -> DataFrame:
    """The columns named in `keep` (new name: SQL expression) and `tokens`, 0 for a null or empty text. Whole texts are encoded.

    The rank file is the one at `path`, else the one that the session's setting
    spark.rostrum.tokenizer names, else `default_path`; executors read it there.
    """
    path = path or df.sparkSession.conf.get("spark.rostrum.tokenizer", "") or default_path()
    rows = df.select(F.col(text_col).cast("string").alias("_text"), *(F.expr(e).alias(n) for n, e in keep.items()))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]) + ", tokens bigint"
    return rows.mapInArrow(_count(path), schema)
