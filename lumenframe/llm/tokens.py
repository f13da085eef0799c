"""Token ids of whole texts, as little-endian unsigned 32-bit bytes, by a public tokenizer file."""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# The pre-token pattern of byte-level BPE, what is left of it where no two white-space
# characters follow each other, and the bytes that stand for themselves in the vocabulary.
_SINGLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_ANY = _SINGLE.removesuffix(r"\s+") + r"\s+(?!\S)|\s+"
_SHOWN = {b: chr(b) for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
_SHOWN |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def default_path() -> str:
    """The file of the public byte-level BPE tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_definition(path: str) -> str:
    """The tokenizer's JSON; the driver reads it once and sends it along with the tasks (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


class Encoder:
    """Texts -> id bytes, without special tokens added (those written in a text keep their id).

    Where a byte-level vocabulary numbers the merges in their order, ids are merge ranks, and the faster of
    the two installed implementations of rank merging gives the same ids as the tokenizer itself. Any other
    tokenizer file is run as it is.
    """

    def __init__(self, definition: str) -> None:
        said = json.loads(definition)
        added = {t["content"]: t["id"] for t in said.get("added_tokens", ())}
        self._added = {content: _packed([i]) for content, i in added.items()}
        names = "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))
        self._cut = regex.compile(f"({names})").split if names else None
        self._spaces = re.compile(r"\s\s").search
        self._tokenizer, ranks = None, merge_ranks(said)
        if ranks is None:
            self._tokenizer = Tokenizer.from_str(definition)
        else:
            self._single, self._any = (
                tiktoken.Encoding(p, pat_str=p, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
                for p in (_SINGLE, _ANY)
            )

    def _part(self, text: str) -> bytes:
        return _packed((self._any if self._spaces(text) else self._single)(text))

    def __call__(self, text: str) -> bytes:
        if self._tokenizer is not None:
            return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
        if not any(t in text for t in self._added):
            return self._part(text)
        return b"".join(self._added[p] if k % 2 else self._part(p) for k, p in enumerate(self._cut(text)))


def merge_ranks(said: dict) -> dict[bytes, int] | None:
    """Token bytes -> id of a byte-level BPE whose ids follow its merges; None for any other tokenizer."""
    pre, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    if (
        pre.get("type") != "ByteLevel"
        or not pre.get("use_regex", True)
        or pre.get("add_prefix_space")
        or said.get("normalizer") is not None
        or model.get("type") != "BPE"
        or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in said.get("added_tokens", ()))
    ):
        return None
    vocab, added = model["vocab"], {t["content"] for t in said.get("added_tokens", ())}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab["".join(m)] for m in merges]
    if made != sorted(made) or len(vocab.keys() - added) != len(merges) + 256:
        return None
    byte = {c: bytes([b]) for b, c in _SHOWN.items()}
    return {b"".join(byte[c] for c in token): i for token, i in vocab.items() if token not in added}


@cache
def encoder(definition: str) -> Encoder:
    """One encoder for each definition and worker."""
    return Encoder(definition)
