"""Byte-level BPE encoders from public vocabulary files, loaded once per worker.

A ``.json`` file of ``tokenizers`` brings its added tokens, a bare rank file has ordinary tokens alone.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np

#: The public split pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Ids of ordinary tokens, from a rank file or from the vocabulary of a ``tokenizers`` file (``.json``)."""
    if path.endswith(".json"):
        return _json_ranks(path)
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def added_tokens(path: str) -> dict[str, int]:
    """Strings that ``tokenizers`` matches as a whole in any text, with their ids; a rank file has none."""
    if not path.endswith(".json"):
        return {}
    found = _definition(path)["added_tokens"]
    if any(t[flag] for t in found for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that look at their surroundings are not supported")
    return {t["content"]: t["id"] for t in found}


def _definition(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    before, model = found["pre_tokenizer"] or {}, found["model"]
    if (found["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or model["type"] != "BPE" or model.get("ignore_merges")):
        raise ValueError(f"{path}: only plain byte-level BPE is supported")
    return found


def _json_ranks(path: str) -> dict[bytes, int]:
    """Bytes that print stand for themselves in the file, the others for the characters from 256 on."""
    found = _definition(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocab, added = found["model"]["vocab"], added_tokens(path)
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in found["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    return {bytes(byte_of[c] for c in piece): rank for piece, rank in vocab.items() if piece not in added}


@lru_cache(maxsize=4)
def encoder(path: str):
    """An encoder of ordinary text; ``n_vocab`` counts added tokens, which :func:`ids_of` matches."""
    import tiktoken

    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens=added_tokens(path))


@lru_cache(maxsize=4)
def _added_pattern(path: str) -> re.Pattern | None:
    longest_first = sorted(added_tokens(path), key=len, reverse=True)
    return re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None


def ids_of(path: str, text: str) -> list[int]:
    """The ids ``tokenizers`` gives with ``add_special_tokens=False``: added tokens in the text are one id each."""
    tool, added = encoder(path), _added_pattern(path)
    if added is None or not added.search(text):
        return tool.encode_ordinary(text)
    out: list[int] = []
    for i, part in enumerate(added.split(text)):
        out += [added_tokens(path)[part]] if i % 2 else tool.encode_ordinary(part)
    return out


@lru_cache(maxsize=4)
def token_lengths(path: str) -> np.ndarray:
    """Bytes per token id."""
    table = {**ranks(path), **{t.encode(): i for t, i in added_tokens(path).items()}}
    out = np.zeros(max(table.values()) + 1, np.int64)
    for piece, rank in table.items():
        out[rank] = len(piece)
    return out
