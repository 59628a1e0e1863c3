"""Token counts per section from one encoding of each whole document.

A document is encoded once. Byte-level tokens concatenate to the text, so running sums of their lengths give
every token's byte span, and an interval join inside the task meets these spans with the sections.

Rule for a token that crosses a section's end: it goes to the section that holds most of its bytes, on a tie
to the earlier one. Every token is counted exactly once, so the sections of a document add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.text import buffer_of, pieces
from furlong.llm.tokens import ids_of, token_lengths

NEWLINE = 10


def sections_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section starts, documents) of lines; a line holds its line end, and an empty text is one empty line."""
    after = np.flatnonzero(raw == NEWLINE) + 1
    after = after[~np.isin(after, offsets)]
    starts = np.sort(np.concatenate([offsets[:-1], after]), kind="stable")
    empty_before = np.searchsorted(starts, offsets[:-1], side="left")
    docs = np.zeros(len(starts), np.int64)
    # Several empty documents share one offset: the k-th entry at an offset belongs to the k-th of them.
    doc_of_offset = np.arange(len(offsets) - 1)
    rank = doc_of_offset - np.searchsorted(offsets[:-1], offsets[:-1], side="left")
    docs[empty_before + rank] = 1
    return starts, np.cumsum(docs) - 1


def attributed(lengths: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """Tokens per section: ``lengths`` are the token lengths from 0, ``starts`` the section starts."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    bounds = np.append(starts, end)
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    home = first.copy()
    held = np.minimum(ends, bounds[first + 1]) - begins
    for step in range(1, int((last - first).max(initial=0)) + 1):
        reach = np.flatnonzero(last - first >= step)
        at = first[reach] + step
        here = np.minimum(ends[reach], bounds[at + 1]) - bounds[at]
        more = here > held[reach]
        home[reach[more]], held[reach[more]] = at[more], here[more]
    return np.bincount(home, minlength=len(starts))


def section_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line of every text: ``key, section (from 0), start_byte, n_bytes, n_tokens, doc_tokens``.

    ``tokenizer`` is the path of a byte-level BPE file on the workers (``tokens.py``). A null or empty text is one
    section without tokens. Lines keep their order, repeated documents and keys are each counted for
    themselves, null keys stay null, other columns are ignored. An empty table gives no rows.
    """
    schema = pa.schema([(key, pa.int64()), ("section", pa.int32()), ("start_byte", pa.int64()),
                        ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("doc_tokens", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = token_lengths(tokenizer)
        for whole in batches:
            for a, b in pieces(whole.column("t")):
                batch = whole.slice(a, b - a)
                raw, offsets = buffer_of(batch.column("t"))
                starts, owner = sections_of(raw, offsets)
                cuts = np.searchsorted(owner, np.arange(len(offsets)))
                n_tokens, totals = np.zeros(len(starts), np.int64), np.zeros(len(offsets) - 1, np.int64)
                for i, value in enumerate(batch.column("t").to_pylist()):
                    if value:
                        ids = np.array(ids_of(tokenizer, value), np.int64)
                        mine = slice(cuts[i], cuts[i + 1])
                        base = offsets[i]
                        n_tokens[mine] = attributed(sizes[ids], starts[mine] - base, offsets[i + 1] - base)
                        totals[i] = len(ids)
                ends = np.append(starts[1:], len(raw))
                numbers = (np.arange(len(starts)) - cuts[owner]).astype(np.int32)
                keys = batch.column("k").take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(numbers), pa.array(starts - offsets[owner]), pa.array(ends - starts),
                     pa.array(n_tokens), pa.array(totals[owner])], schema=schema)

    ddl = f"`{key}` long, section int, start_byte long, n_bytes long, n_tokens long, doc_tokens long"
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(count, ddl)
