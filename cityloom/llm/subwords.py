"""Encoding of many distinct words by the tokenizers library at once."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Letters and marks between which every supported splitting pattern has a boundary; none of the marks is
# part of a special token.
MARKS = ".,;:!?%&*$#"
_LONGEST_MARK = 4
_STEM = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_CHUNK = 2_000
# Words and stems remembered by a worker before it starts afresh: bounds its memory, changes no result.
_MEMORY = 800_000


class WordEncoder:
    """Ids of words as a tokenizer file gives them inside any text, as little-endian numbers of ``width``
    bytes.

    ``words`` must be cut from a text at places where the file's own pattern always cuts: at white space
    for files with word ends (``</w>``), before white space for byte-level files, whose words keep the white
    space in front. Words of plain letters, perhaps with sentence marks behind, are encoded in long runs,
    each stem once; the ids themselves show where a stem begins or ends. All others go in one by one.
    """

    def __init__(self, path: str, width: int | None = None) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, normal = data["model"], data.get("normalizer") or {}
        self.lowers = any(n["type"] == "Lowercase" for n in (normal, *normal.get("normalizers", ())) if "type" in n)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.word_ends = model.get("end_of_word_suffix")
        self.edge = np.zeros(max(max(model["vocab"].values()) + 1, self.tokenizer.get_vocab_size()), bool)
        for token, i in model["vocab"].items():
            self.edge[i] = token.endswith(self.word_ends) if self.word_ends else token.startswith("Ġ")
        self.width = width or (2 if len(self.edge) <= 65_536 else 4)
        self.kind = f"<u{self.width}"
        self.stems: dict[str, bytes | None] = {}
        self.words: dict[str, bytes] = {}

    def forget(self) -> None:
        self.stems, self.words = {}, {}

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), _CHUNK):
            batch = self.tokenizer.encode_batch_fast(words[i : i + _CHUNK], add_special_tokens=False)
            out.extend(np.array(e.ids, self.kind).tobytes() for e in batch)
        return out

    def _runs(self, stems: list[str]) -> None:
        for i in range(0, len(stems), _CHUNK):
            part = stems[i : i + _CHUNK]
            text = (" " if self.word_ends else "").join(part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            edges = np.flatnonzero(self.edge[ids])
            cuts = [0, *((edges + 1) * self.width).tolist()] if self.word_ends else [*(edges * self.width).tolist(), ids.nbytes]
            if len(cuts) == len(part) + 1:
                raw = ids.tobytes()
                self.stems.update(zip(part, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
            else:
                self.stems.update(zip(part, self._one_by_one(part), strict=True))

    def _learn(self, stems: Iterable[str]) -> None:
        """Remember stems; one that is no plain word is remembered as None."""
        if len(self.stems) > _MEMORY:
            self.stems = {}
        unseen = {s for s in stems if s not in self.stems}
        plain = [s for s in unseen if _STEM.fullmatch(s) and (s[0] == " ") != bool(self.word_ends)]
        self.stems.update(dict.fromkeys(unseen))
        self._runs(plain)

    def whole(self, words: list[str]) -> list[bytes]:
        """Ids of words that are taken as they are."""
        if len(self.words) > _MEMORY:
            self.words = {}
        new = list({w for w in words if w not in self.words})
        self.words.update(zip(new, self._one_by_one(new), strict=True))
        return [self.words[w] for w in words]

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        stems = [w.rstrip(MARKS) for w in words]
        self._learn(stems)
        known, marks = self.stems, dict.fromkeys(w[len(s) :] for w, s in zip(words, stems, strict=True))
        marks = dict(zip(marks, self.whole(list(marks)), strict=True))
        odd = [w for w, s in zip(words, stems, strict=True) if known[s] is None]
        apart = dict(zip(odd, self.whole(odd), strict=True))
        return [
            apart[w] if known[s] is None else known[s] + marks[w[len(s) :]] for w, s in zip(words, stems, strict=True)
        ]

    def encode_array(self, words: pa.Array) -> pa.Array:
        """``encode`` for an Arrow array of strings, as an array of binaries: what Python sees is each stem once."""
        stems = pc.utf8_rtrim(words, characters=MARKS)
        behind = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy(zero_copy_only=False)
        coded = stems.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(names)
        out = pa.array(list(map(self.stems.__getitem__, names)), pa.large_binary()).take(coded.indices)
        # Words behind which the marks are of one length have them cut off together.
        odd = out.is_null().to_numpy(zero_copy_only=False) | (behind > _LONGEST_MARK)
        marked, ids = [np.flatnonzero(behind == 0)], [pa.array([b""] * int((behind == 0).sum()), pa.large_binary())]
        for n in range(1, _LONGEST_MARK + 1):
            at = np.flatnonzero(behind == n)
            cut = pc.utf8_slice_codeunits(words.take(pa.array(at)), -n).dictionary_encode()
            marked.append(at)
            ids.append(pa.array(self.whole(cut.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(cut.indices))
        at = np.flatnonzero(behind > _LONGEST_MARK)
        place = np.empty(len(words), np.int64)
        place[np.concatenate([*marked, at])] = np.arange(len(words))
        ids.append(pa.array([b""] * len(at), pa.large_binary()))
        out = pc.binary_join_element_wise(out, pa.concat_arrays(ids).take(pa.array(place)), pa.scalar(b"", pa.large_binary()))
        if not odd.any():
            return out
        mask = pa.array(odd)
        return pc.replace_with_mask(out, mask, pa.array(self.whole(words.filter(mask).to_numpy(zero_copy_only=False).tolist()), pa.large_binary()))


@lru_cache(maxsize=4)
def word_encoder(path: str, width: int | None = None) -> WordEncoder:
    """One encoder per worker and file."""
    return WordEncoder(path, width)
