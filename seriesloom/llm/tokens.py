"""Token ids of many texts, with a cache of what stands between two spaces.

The byte-level pre-tokenizer always starts a new token at a space that a non-space follows.
A text without other runs of spaces is thus the sequence of its space-separated parts, each
of which can be looked up; the parts of a step that were not seen before are encoded together
in one call and cut at the tokens that begin with a space. Any other text, and one that holds
the string of a special token, is encoded as it is.
"""

from __future__ import annotations

import os

import numpy as np

#: Parts that a generation of a task's cache holds; there are two, and a part that is met
#: again moves to the young one.
CACHE_PARTS = 250_000
#: Parts encoded as one string; long strings cost the tokenizer twice as much a part.
GROUP = 64


class Encoder:
    """ids(texts) -> one numpy array of ids per text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.spaced = np.array(
            [(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)]
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give the cache's memory back; tasks do so at their end."""
        self.cache, self.old = {}, {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind) for x in found]

    def _learn(self, parts: set[str]) -> None:
        """All of `parts` are in the young generation afterwards."""
        missing = parts - self.cache.keys()
        if len(self.cache) + len(missing) > CACHE_PARTS:
            self.cache, self.old, missing = {}, self.cache, parts
        known = missing & self.old.keys()
        self.cache.update(zip(known, map(self.old.__getitem__, known)))
        fresh = list(missing - known)
        if not fresh:
            return
        groups = [fresh[k : k + GROUP] for k in range(0, len(fresh), GROUP)]
        ids = np.concatenate(self._encode([" " + " ".join(g) for g in groups]))
        cuts = (np.flatnonzero(self.spaced[ids]) * self.kind.itemsize).tolist()
        raw = ids.tobytes()
        for part, a, b in zip(fresh, cuts, [*cuts[1:], len(raw)], strict=True):
            self.cache[part] = raw[a:b]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split, whole, every = {}, [], set()
        for i, text in enumerate(texts):
            if text[:1].isspace() or text[-1:].isspace() or any(map(text.__contains__, self.special)):
                whole.append(i)
            else:
                first, *parts = text.split(" ")
                split[i] = (first, parts)
                every.update(parts)
        odd = {p for p in every if not p or p[0].isspace()}
        if odd:
            mixed = [i for i, (_, parts) in split.items() if not odd.isdisjoint(parts)]
            whole += mixed
            for i in mixed:
                del split[i]
            every -= odd
        self._learn(every)
        heads = list({first for first, _ in split.values()})
        encoded = self._encode([texts[i] for i in whole] + heads)
        out: list = [None] * len(texts)
        for i, x in zip(whole, encoded):
            out[i] = x
        starts = {h: x.tobytes() for h, x in zip(heads, encoded[len(whole):])}
        known = self.cache.__getitem__
        for i, (first, parts) in split.items():
            out[i] = np.frombuffer(starts[first] + b"".join(map(known, parts)), self.kind)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, so that the file is read once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
