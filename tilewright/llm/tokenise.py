"""Whole-text encoding with the ``tokenizers`` library.

Byte-level BPE splits a text by a pattern in which a space always opens a new
pre-token, so a text can be encoded as its space-separated units, one after the
other, and the ids of a unit can be remembered. The exceptions are spaces next
to other white space, where the pattern looks over the boundary; such texts go
through the library whole. Tokenizers of any other kind always do.

A unit that is made of letters, digits, plain punctuation and single line ends has
its pre-tokens in plain sight; these go to the library's model one by one, so a
word costs the same once with and without a full stop.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np

#: A space beside other white space (or at the end behind some).
_ACROSS = re.compile(r"\s (?:\s|\Z)")
#: Pre-tokens that can be told apart without the tokenizer's own pattern.
_PLAIN = re.compile(r" ?[^\W\d_]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    bytes for themselves, the others for the letters from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()
_STOPS = frozenset(".,;:!?")
#: Longer units are not remembered. Bytes of an entry besides its letters and ids.
_LONGEST, _ENTRY = 64, 170


class TextEncoder:
    """``encode(texts)`` gives, per text, its ids as little-endian uint32 bytes.

    remember: bytes of the units and ids that are kept, which bounds the memory of a
    worker; long units are never kept.
    """

    def __init__(self, path: str, remember: int = 64 << 20):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.tokenizer = Tokenizer.from_str(spec)
        self.room = remember
        self.by_unit = _splits_at_spaces(json.loads(spec))
        # ids of units behind a space, and of pre-tokens of any other kind
        self.tails: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, memo: dict[str, bytes], unit: str, ids: bytes) -> None:
        if self.room > 0 and len(unit) <= _LONGEST and unit not in memo:
            memo[unit] = ids
            self.room -= _ENTRY + len(unit) + len(ids)

    def _word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        memo, key = (self.tails, word[1:]) if word[0] == " " and word[1:].isalpha() else (self.words, word)
        found = memo.get(key)
        if found is None:
            if word.isascii() and word.isalnum():
                letters = word
            else:
                letters = word.encode().decode("latin-1").translate(_LETTERS)
            ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            self._keep(memo, key, found)
        return found

    def _units(self, units: list[str], lead: str) -> list[bytes]:
        """The ids of units with ``lead`` before each."""
        out: list[bytes | None] = []
        word = self._word
        for u in units:
            if u.isalpha():
                out.append(word(lead + u))
            elif u[-1:] in _STOPS and u[:-1].isalpha():
                out.append(word(lead + u[:-1]) + word(u[-1]))
            else:
                u = lead + u
                parts = _PLAIN.findall(u)
                plain = len("".join(parts)) == len(u) and "\n\n" not in u and "<|" not in u
                if plain and not u.isascii():
                    # word characters beyond ASCII may be numbers of other kinds
                    plain = all(p.isascii() or p.strip(" ").isalpha() for p in parts)
                out.append(b"".join(map(word, parts)) if plain else None)
        others = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(others, self._library([lead + units[k] for k in others]), strict=True):
            out[k] = ids
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        found: list[list[bytes | None] | None] = [None] * len(texts)
        gaps: dict[int, tuple[list[int], list[str]]] = {}
        whole: list[int] = []
        heads: dict[str, bytes] = {}
        tails: dict[str, bytes] = {}
        for i, text in enumerate(texts):
            if not text:
                out[i] = b""
            elif not self.by_unit or _ACROSS.search(text) or text[0] == " " and text[:2].isspace():
                whole.append(i)
            else:
                units = text.split(" ")
                found[i] = ids = list(map(self.tails.get, units))
                ids[0] = None  # the first has no space before it
                at = [k for k, x in enumerate(ids) if x is None] if None in ids[1:] else [0]
                missing = [units[k] for k in at]
                gaps[i] = at, missing
                heads[missing[0]] = b""
                tails.update(dict.fromkeys(missing[1:], b""))
        for i, ids in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = ids
        for new, lead in ((heads, ""), (tails, " ")):
            for u, ids in zip(list(new), self._units(list(new), lead), strict=True):
                new[u] = ids
        for i, (at, missing) in gaps.items():
            ids = found[i]
            ids[0] = heads[missing[0]]
            for k, u in zip(at[1:], missing[1:], strict=True):
                ids[k] = tails[u]
            out[i] = b"".join(ids)
        for u, ids in tails.items():
            self._keep(self.tails, u, ids)
        return out


def _splits_at_spaces(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not spec.get("normalizer")
        and spec.get("model", {}).get("type", "BPE") == "BPE"
        and not spec["model"].get("dropout")
        and all("<|" in t["content"] and " " not in t["content"] and not t.get("lstrip") and not t.get("rstrip") for t in spec.get("added_tokens", []))
    )


@lru_cache(maxsize=1)
def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker, kept between tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return TextEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
