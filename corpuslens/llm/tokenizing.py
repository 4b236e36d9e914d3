"""Exact token ids of whole texts by the tokenizers library, with a bounded table of splits.

The library parts a text into splits (words, numbers, marks) and merges each by itself. For
Latin-1 texts the splits are found here, many texts at once, by NumPy; a split that was
seen before is looked up in a table of fixed size by its exact bytes, and new ones are
merged by the library. This is done only where the loaded normaliser and pre-tokenizer are
those that it was written for. Every text of another vocabulary, and every text with
characters beyond Latin-1, unusual white space or a special token, goes to the library.

Long texts are cut before a single space between letters or digits, where no split can
cross, so that memory is bounded by pieces and not by texts.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from corpuslens.llm.shingles import mix

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
#: Slots of the table (half of them are used), and the longest split in it, in bytes.
SLOTS, LONGEST = 1 << 19, 24
#: Characters of a piece of text and of the pieces encoded at once; splits merged at once.
PIECE_CHARS, BATCH_CHARS, BATCH_SPLITS = 1 << 18, 1 << 20, 4_000

#: How the library prints the parts that the splitting below was written for.
_BYTE_PARTS = ("None", "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)")
_WORD_PARTS = (
    r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])',
    r"""Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])""",
)

_LETTER, _DIGIT, _OTHER, _SPACE = range(4)
_KIND = np.array([{"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(256)], np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < 256 else c for c in range(256)], np.uint8)
#: White space that is not in all the definitions of it, and the byte that pads keys.
_ODD = np.zeros(256, bool)
_ODD[[0, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_CUT = re.compile(r"(?<=[^\W_])(?= [^\W_])")


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary; ``name`` may be a path of its own."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_long(text: str, limit: int) -> Iterator[str]:
    """``text`` in pieces of about ``limit`` characters, cut where no split can cross."""
    at = 0
    while len(text) - at > limit:
        m = _CUT.search(text, at + limit)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def split_spans(data: np.ndarray, offsets: np.ndarray, leads: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the splits of Latin-1 texts ``data[offsets[k]:offsets[k+1]]``.

    With ``leads`` a space belongs to what follows it and other white space is split too;
    else white space goes and each digit is a split.
    """
    kind = _KIND[data]
    first = np.ones(len(data), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    if not leads:
        first |= kind == _DIGIT
    a = np.flatnonzero(first)
    b = np.append(a[1:], len(data))
    kinds = kind[a]
    joined = np.ones(len(a), bool)  # the run after this one is of the same text
    last = np.searchsorted(a, offsets[1:]) - 1
    joined[last[last >= 0]] = False
    joined[len(a) - 1 :] = False
    bare = np.ones(len(a), bool)  # no space goes before the run
    more = np.zeros(0, np.int64)
    if leads:
        gap = np.flatnonzero((kinds == _SPACE) & joined)
        tail = data[b[gap] - 1] == 32
        lead, other = gap[tail], gap[~tail]
        b[lead] -= 1
        a[lead + 1] -= 1
        bare[lead + 1] = False
        more = other[b[other] - a[other] > 1]  # all but the last character, then the last one
        b[more] -= 1
    quote = np.flatnonzero((kinds == _OTHER) & joined & bare & (b - a == 1))
    quote = quote[(data[a[quote]] == 39) & (kinds[np.minimum(quote + 1, len(a) - 1)] == _LETTER)]
    if len(quote):
        after = data[a[quote] + 1]
        second = np.where(b[quote + 1] - a[quote + 1] > 1, data[np.minimum(a[quote] + 2, len(data) - 1)], 0)
        take = np.where(np.isin(after, list(b"stmd")), 1, 0)
        take = np.where(((after == 114) & (second == 101)) | ((after == 118) & (second == 101)) | ((after == 108) & (second == 108)), 2, take)
        b[quote] += take
        a[quote + 1] += take
    if len(more):
        ends = b[more]
        a, b, kinds = np.insert(a, more + 1, ends), np.insert(b, more + 1, ends + 1), np.insert(kinds, more + 1, _SPACE)
    keep = b > a if leads else (b > a) & (kinds != _SPACE)
    return a[keep], b[keep]


class SplitTable:
    """Ids of splits of up to ``LONGEST`` bytes, found by their bytes in open addressing."""

    def __init__(self, slots: int):
        self.slots, self.most = slots, slots // 2
        self.clear()

    def clear(self) -> None:
        self.slot = np.full(self.slots, -1, np.int32)
        self.keys = np.zeros((1024, 3), np.uint64)
        self.starts, self.counts = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.uint32)
        self.size = self.used = 0

    def find(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where there is none."""
        at = (hashes & np.uint64(self.slots - 1)).astype(np.int64)
        out = self.slot[at]
        live = np.flatnonzero(out >= 0)
        while len(live):
            live = live[(self.keys[out[live]] != keys[live]).any(axis=1)]
            at[live] = (at[live] + 1) & (self.slots - 1)
            out[live] = self.slot[at[live]]
            live = live[out[live] >= 0]
        return out

    def add(self, keys: np.ndarray, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Add distinct keys that aren't there; there must be room."""
        n, size = len(keys), self.size
        while size + n > len(self.keys):
            self.keys = np.concatenate((self.keys, np.zeros_like(self.keys)))
            self.starts, self.counts = np.append(self.starts, np.zeros_like(self.starts)), np.append(self.counts, np.zeros_like(self.counts))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.keys[size : size + n], self.counts[size : size + n] = keys, counts
        self.starts[size : size + n] = self.used + np.cumsum(counts) - counts
        self.ids[self.used : self.used + len(ids)] = ids
        at, left = (hashes & np.uint64(self.slots - 1)).astype(np.int64), np.arange(n)
        while len(left):
            free = left[self.slot[at[left]] < 0]
            _, which = np.unique(at[free], return_index=True)
            self.slot[at[free[which]]] = size + free[which]
            left = left[self.slot[at[left]] != size + left]
            at[left] = (at[left] + 1) & (self.slots - 1)
        self.size, self.used = size + n, self.used + len(ids)


class TextEncoder:
    """``encode`` gives the ids of texts, as the library's ``encode`` does."""

    def __init__(self, name: str, slots: int = SLOTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(vocabulary_path(name))
        added = self.library.get_added_tokens_decoder().values()
        parts = (str(self.library.normalizer), str(self.library.pre_tokenizer))
        self.leads, self.special = parts == _BYTE_PARTS, [a.content for a in added]
        self.known = parts in (_BYTE_PARTS, _WORD_PARTS) and not any(a.normalized or a.lstrip or a.rstrip or a.single_word or " " in a.content for a in added)
        if self.known:
            self.merger = Tokenizer.from_file(vocabulary_path(name))
            self.merger.normalizer = None
            self.merger.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.table = SplitTable(slots)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each split has, and all of them."""
        raw = data.tobytes().decode("latin-1")
        splits = [raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        counts, ids = [], []
        for k in range(0, len(splits), BATCH_SPLITS):
            for e in self.merger.encode_batch_fast(splits[k : k + BATCH_SPLITS], add_special_tokens=False):
                own = e.ids
                counts.append(len(own))
                ids += own
        return np.array(counts, np.int32), np.array(ids, np.uint32)

    def _latin(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of the Latin-1 texts in ``data``."""
        if not self.leads:
            data = _LOWER[data]
        a, b = split_spans(data, offsets, self.leads)
        size = b - a
        eights = np.ndarray((len(data) + 17,), "<u8", data.tobytes() + bytes(24), strides=(1,))
        keys = np.stack([eights[np.minimum(a + 8 * k, len(data))] & _MASK[np.clip(size - 8 * k, 0, 8)] for k in range(3)], axis=1)
        hashes = mix(keys[:, 0] ^ mix(keys[:, 1] ^ mix(keys[:, 2])))
        short, table = size <= LONGEST, self.table
        entry = table.find(keys, hashes)
        entry[~short] = -1
        new = np.flatnonzero(entry < 0)
        if table.size >= table.most and 4 * len(new) > len(a):  # the texts have changed their kind
            table.clear()
            entry[:] = -1
            new = np.arange(len(a))
        starts, counts, ids = table.starts, table.counts, table.ids
        if len(new):
            _, first, same = np.unique(hashes[new], return_index=True, return_inverse=True)
            lone = ~short[new] | (keys[new] != keys[new][first[same]]).any(axis=1)  # too long, or like another's hash
            one = first[short[new][first] & ~lone[first]]  # an example of each new split
            alone = np.flatnonzero(lone)
            made = new[np.concatenate((one, alone))]
            count, found = self._merged(data, a[made], b[made])
            room = min(len(one), table.most - table.size)
            kept = int(count[:room].sum())
            base = table.size
            table.add(keys[made[:room]], hashes[made[:room]], count[:room], found[:kept])
            # those beyond the room, and the lone ones, are entries of this batch only
            starts = np.concatenate((table.starts[: table.size], table.used + np.cumsum(count[room:]) - count[room:]))
            counts, ids = np.concatenate((table.counts[: table.size], count[room:])), np.concatenate((table.ids[: table.used], found[kept:]))
            number = np.full(len(first), -1, np.int64)
            number[same[one]] = base + np.arange(len(one))
            entry[new] = number[same]
            entry[new[alone]] = base + len(one) + np.arange(len(alone))
        count = counts[entry].astype(np.int64)
        ends = np.cumsum(count)
        out = ids[np.repeat(starts[entry] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate(([0], ends))[np.searchsorted(a, offsets)].tolist()
        return [out[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        raw: list[bytes | None] = [None] * len(texts)
        if self.known:
            for k, t in enumerate(texts):
                if not any(s in t for s in self.special):
                    try:
                        raw[k] = t.encode("latin-1")
                    except UnicodeEncodeError:
                        continue
        plain = [k for k, r in enumerate(raw) if r is not None]
        data = np.frombuffer(b"".join(raw[k] for k in plain), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(raw[k]) for k in plain], dtype=np.int64)))
        if len(bad := np.flatnonzero(_ODD[data])):
            gone = set(np.searchsorted(offsets, bad, "right").tolist())
            plain = [k for i, k in enumerate(plain) if i + 1 not in gone]
            data = np.frombuffer(b"".join(raw[k] for k in plain), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(raw[k]) for k in plain], dtype=np.int64)))
        out: list = [None] * len(texts)
        if len(data):
            for k, ids in zip(plain, self._latin(data, offsets), strict=True):
                out[k] = ids
        else:
            for k in plain:
                out[k] = np.zeros(0, np.uint32)
        odd = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(odd, self._whole([texts[k] for k in odd]), strict=True):
            out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers."""
        pieces = [[t] if len(t) <= PIECE_CHARS or not self.known else list(cut_long(t, PIECE_CHARS)) for t in texts]
        flat = list(chain.from_iterable(pieces))
        done: list[np.ndarray] = []
        while (k := len(done)) < len(flat):
            size, end = 0, k
            while end < len(flat) and (end == k or size + len(flat[end]) <= BATCH_CHARS):
                size += len(flat[end])
                end += 1
            done += self._batch(flat[k:end])
        ids = iter(done)
        return [next(ids) if len(own) == 1 else np.concatenate([next(ids) for _ in own]) for own in pieces]


@lru_cache(maxsize=1)
def encoder(name: str) -> TextEncoder:
    """The encoder of the vocabulary used last: workers are used again, its table is bounded."""
    return TextEncoder(name)
