"""Token counts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework.functions.text import WHITE_SPACE

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published splitting pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_SPACE = 5000

_encoders: dict = {}


def encoder(ranks: bytes):
    """The tokenizer of a rank file's content; built once a process."""
    if ranks not in _encoders:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders.clear()
        _encoders[ranks] = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[ranks]


def count_tokens(encoding, text: str | None, long_space: int = LONG_SPACE) -> int:
    """The tokens of a text, exactly, also where white space runs on so long that the pattern's look-ahead overflows.

    By the pattern such a run is one piece without its last character (which goes with what follows), or as a
    whole at the end of the text; it is encoded as that piece and the text is cut there.
    """
    if not text:
        return 0
    if len(text) < long_space or not (runs := list(re.finditer(f"[{WHITE_SPACE}]{{{long_space},}}", text))):
        return len(encoding.encode_ordinary(text))
    total, at = 0, 0
    for run in runs:
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def with_token_counts(df: DataFrame, keep: Sequence[str], text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``, the tokens of the whole text (null text: 0; special tokens are plain text).

    The vocabulary file (under 1 MB) is read by the driver and sent to the executors.
    """
    with open(vocabulary, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(sent.value)
        for batch in batches:
            n = [count_tokens(encoding, t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], names=schema.names)

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(count, schema)
