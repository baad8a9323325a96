"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter and travels with the tasks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A byte-level BPE for many languages, as ranks.
DEFAULT_FILE = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that this vocabulary's words were cut by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[int, object] = {}


def load(content: bytes):
    """The encoding of a rank file's content, once a process."""
    import tiktoken

    key = xxhash.xxh3_64_intdigest(content)
    if key not in _LOADED:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        _LOADED[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[key]


def count_tokens(df: DataFrame, keep: list[str], text: str, file: str = DEFAULT_FILE) -> DataFrame:
    """``keep, n_tokens``: the size of each row's whole text; null and empty texts have 0. Other columns are left out."""
    content = Path(file).read_bytes()
    source = df.select(*keep, F.col(text).alias("_text"))
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema] + ["n_tokens long"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(content)
        for b in batches:
            sizes = [len(enc.encode_to_numpy(t, disallowed_special=())) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(sizes, pa.int64())], names=[*keep, "n_tokens"])

    return source.mapInArrow(count, ddl)
