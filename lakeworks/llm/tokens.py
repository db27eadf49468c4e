"""Token counts of whole texts by a given public tokenizer: Arrow batches in, lengths out.

Only lengths leave the Python workers. A text is split at ASCII white space, where the tokenizer's own
pre-tokenisation always cuts and no added token can span, so the count of a text is the sum over its
pieces and a text of any length needs no more memory than its pieces. Pieces not met before are encoded
together in batches of about ``BATCH_BYTES``; a bounded table keeps the lengths of pieces met already.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.textops import limit_batches, texts_of

BATCH_BYTES = 256 * 1024
#: lengths kept per worker; the table starts anew when it is full
KEPT_PIECES = 300_000
#: bytes of texts looked up together
GROUP_BYTES = 4 * 1024 * 1024
_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _encode_new(tokenizer, pieces: set[bytes], lengths: dict[bytes, int]) -> None:
    batch, size = [], 0
    todo = sorted(pieces, key=len)  # pieces of like length together: batches balanced by bytes
    for k, piece in enumerate(todo):
        batch.append(piece)
        size += len(piece)
        if size >= BATCH_BYTES or k == len(todo) - 1:
            found = tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in batch], add_special_tokens=False)
            lengths.update(zip(batch, (len(e) for e in found)))
            batch, size = [], 0


def count_texts(texts: list[bytes], tokenizer, lengths: dict[bytes, int]) -> list[int]:
    """Token counts of UTF-8 texts; ``lengths`` is the table of pieces met already."""
    out: list[int] = []
    k = 0
    while k < len(texts):
        group, size = [], 0
        while k < len(texts) and (not group or size + len(texts[k]) <= GROUP_BYTES):
            group.append(texts[k].split())
            size += len(texts[k])
            k += 1
        if len(lengths) > KEPT_PIECES:
            lengths.clear()
        new = set().union(*group).difference(lengths)
        _encode_new(tokenizer, new, lengths)
        out += [sum(map(lengths.__getitem__, pieces)) for pieces in group]
    return out


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer_path``: a ``tokenizers`` JSON file that every executor can read. No begin, end or other
    special tokens are added; their strings inside a text count as the library's default has it. Null
    text counts as empty (0 bytes, 0 tokens); ids may be null or repeat; other columns are ignored; an
    empty table gives no rows. The tokenizer must cut at white space (checked on the first use).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, lengths = _tokenizer(tokenizer_path), {}
        probe = ["a b\n\tc", "a", "b", "c"]
        whole, *parts = (len(e) for e in tokenizer.encode_batch_fast(probe, add_special_tokens=False))
        if whole != sum(parts):
            raise ValueError("this tokenizer does not cut texts at white space")
        for batch in batches:
            texts = texts_of(batch.column(1))
            n = count_texts(texts, tokenizer, lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    limit_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
