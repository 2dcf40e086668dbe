"""Training examples from chat records: token ids and labels that carry loss on the reply alone."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

IGNORED = -100
#: Records that are tokenized and handed back at a time: an id takes far more memory as a Python object than in Arrow.
ROWS = 64
SCHEMA = "input_ids array<int>, attention_mask array<int>, labels array<int>"


def render(messages: list[dict], reply_next: bool = False) -> str:
    """Messages between role markers; with ``reply_next`` the assistant's marker is open at the end."""
    said = "".join(f"<|im_start|>{m['role']}\n{m['content'] or ''}<|im_end|>\n" for m in messages)
    return said + ("<|im_start|>assistant\n" if reply_next else "")


@lru_cache(maxsize=2)
def _tokenizer(path: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def example(messages: list[dict], encode, longest: int) -> tuple[list[int], list[int]]:  # noqa: ANN001
    """(ids, labels): everything before the last message is the prompt; nothing is masked if the prompt fills all."""
    ids = encode(render(messages))[:longest]
    prompt = len(encode(render(messages[:-1], reply_next=True))[:longest])
    return ids, [IGNORED] * prompt + ids[prompt:] if 0 < prompt < len(ids) else list(ids)


def tokenized(records: DataFrame, tokenizer_path: str, longest: int = 2048) -> DataFrame:
    """A row of SCHEMA for each record with messages, cut to ``longest`` ids. No shuffle; Arrow batches, ROWS at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        lists = pa.list_(pa.int32())
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                rows = [example(m, encode, longest) for m in batch.column(0).slice(lo, ROWS).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], lists), pa.array([[1] * len(i) for i, _ in rows], lists), pa.array([x for _, x in rows], lists)], ["input_ids", "attention_mask", "labels"])

    return records.where("size(messages) > 0").select("messages").mapInArrow(run, SCHEMA)
