"""Exact token ids of whole texts with the `tokenizers` library, with a memo of the chunks that texts are cut into."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks, and bytes of chunks, that a Python worker remembers; beyond either those that were met in one slice only go,
#: and if still too many are left, all go.
MEMO_CHUNKS, MEMO_BYTES = 200_000, 32_000_000
#: Characters of one slice of texts that is encoded together.
SLICE_CHARS = 4_000_000

#: White space as the byte-level pre-tokenizer's pattern has it (Unicode White_Space): fixed values.
BLANKS = "\t-\r \x85\xa0  -     　"
#: Texts that a cut before every single blank and line break would not cut rightly.
_ODD = r"[\t\x{0b}-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n]{3}|[ \n]{2}\z"
_chunks = re.compile(f"[{BLANKS}]+[^{BLANKS}]*|[^{BLANKS}]+").findall
_blanks = frozenset(filter(re.compile(f"[{BLANKS}]").match, map(chr, range(0x3001))))

_loaded: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> Encoder:
    """One encoder for each path and Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array itself if it has `size` places, else a copy with twice as many."""
    if size <= len(array):
        return array
    out = np.zeros(2 * size, array.dtype)
    out[: len(array)] = array
    return out


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of all runs, one run after the other."""
    total = np.cumsum(size)
    return np.repeat(begin - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)


def strings(array: pa.Array) -> list[str]:
    """What `to_pylist` gives for strings without nulls, made by Arrow in one go."""
    return array.to_numpy(zero_copy_only=False).tolist()


class Memo:
    """Chunks by slot, and the ids of each."""

    def __init__(self, dtype: np.dtype):
        self.chunks = pa.array([], pa.large_string())
        self.begin, self.size, self.hits = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.flat, self.used = np.zeros(1 << 18, dtype), 0

    def __len__(self) -> int:
        return len(self.chunks)

    def find(self, chunks: pa.Array) -> np.ndarray:
        """The slot of each chunk, -1 if it is unknown."""
        return pc.fill_null(pc.index_in(chunks, value_set=self.chunks), -1).to_numpy().astype(np.int64)

    def put(self, chunks: pa.Array, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The new slots of chunks, whose ids lie one after the other."""
        old, self.chunks = len(self), pa.concat_arrays([self.chunks, chunks])
        n = len(self)
        self.begin, self.size, self.hits = (grown(a, n) for a in (self.begin, self.size, self.hits))
        self.flat = grown(self.flat, self.used + len(ids))
        self.begin[old:n], self.size[old:n], self.hits[old:n] = self.used + np.cumsum(size) - size, size, 0
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return np.arange(old, n)

    def full(self) -> bool:
        return len(self) > MEMO_CHUNKS or self.chunks.nbytes > MEMO_BYTES

    def lean(self) -> Memo:
        """A memo of the chunks that were met in more slices than one, or an empty one if these are over half of what it may hold."""
        out, often = Memo(self.flat.dtype), np.flatnonzero(self.hits[: len(self)] > 1)
        kept = self.chunks.take(pa.array(often))
        if 2 * len(kept) <= MEMO_CHUNKS and 2 * kept.nbytes <= MEMO_BYTES:
            out.put(kept, *self.take(often))
        return out

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all slots in a row, ids of each)."""
        size = self.size[slots]
        return self.flat[runs(self.begin[slots], size)], size


class Encoder:
    """Ids of texts, 2 bytes an id if the vocabulary allows, else 4.

    Byte-level BPE cuts a text wherever white space begins, so the ids of a text are the ids of its chunks (a run of
    white space and what follows it up to the next), joined.  Chunks repeat a lot: those of a slice are made distinct by
    Arrow, and distinct ones are remembered.  A text whose white space is single or double blanks and line breaks is cut
    before each of them; any other text by a pattern.
    Every other kind of tokenizer encodes whole texts.
    """

    _marks = "!#$%&()*+,-./:;<=>?@[]^_{|}~"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.dtype = np.dtype("<u2") if max(vocab.values(), default=0) < 2**16 else np.dtype("<u4")
        kind = str(self.tokenizer.pre_tokenizer)
        plain = not any(t.lstrip or t.rstrip or t.single_word or re.search(f"[{BLANKS}]", t.content) for t in added.values())
        self.added = [t.content for t in added.values()]
        self.by_chunk = plain and self.tokenizer.normalizer is None and kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
        self.token_bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, at in vocab.items():
            self.token_bytes[at] = len(added[at].content.encode()) if at in added else len(token)  # one character a byte at byte level
        self.memo = Memo(self.dtype)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each), straight from the tokenizer."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), self.dtype), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each), each text followed by `end_id` if given; null counts as empty."""
        texts = [t or "" for t in texts]
        if self.by_chunk:
            if self.memo.full():
                self.memo = self.memo.lean()
            cut, counts, marked = self._cut(texts)
            distinct = cut.dictionary_encode()
            slots = self._slots(distinct.dictionary, marked)
            self.memo.hits[slots] += 1
            ids, size = self.memo.take(slots[distinct.indices.to_numpy()])
            size = np.diff(np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])])
        else:
            ids, size = self.whole(texts)
        if end_id is not None:
            ids, size = np.insert(ids, np.cumsum(size), end_id), size + 1
        return ids, size

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, bool]:
        """(chunks of all texts in a row, chunks of each, whether any text holds an added token); the chunks share the texts' bytes."""
        held = pa.array(texts, pa.large_string())
        added = pa.array(np.zeros(len(texts), bool))
        for token in self.added:
            added = pc.or_(added, pc.match_substring(held, token))
        odd = pc.or_(added, pc.match_substring_regex(held, _ODD)).to_numpy(zero_copy_only=False)
        _, offsets, data = held.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(texts) + 1) if texts else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)[: offsets[-1]]
        first = (data == ord(" ")) | (data == ord("\n"))
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        for i in np.flatnonzero(odd).tolist():
            size = np.array([len(c.encode()) for c in _chunks(texts[i])], np.int64)
            first[offsets[i] : offsets[i + 1]] = False
            first[offsets[i] + np.cumsum(size) - size] = True
        begin = np.flatnonzero(first)
        chunks = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data))
        return chunks, np.diff(np.searchsorted(begin, offsets)), pc.any(added).as_py() or False

    def _slots(self, chunks: pa.Array, marked: bool) -> np.ndarray:
        """The slots of distinct chunks; unknown ones get their ids from a stem and its marks, or from the tokenizer.

        Only where texts are `marked` may a chunk hold an added token.
        """
        memo = self.memo
        slots = memo.find(chunks)
        new = np.flatnonzero(slots < 0)
        if not len(new):
            return slots
        fresh = chunks.take(pa.array(new))
        stems = pc.utf8_rtrim(fresh, self._marks)
        marks = (pc.binary_length(fresh).to_numpy() - pc.binary_length(stems).to_numpy()).tolist()
        texts, ends = strings(fresh), strings(stems)
        # a run of marks after a letter or digit is cut off by itself
        by_stem = np.array([k > 0 and s != "" and s[-1].isalnum() for k, s in zip(marks, ends, strict=True)], bool)
        if marked:
            for token in self.added:
                by_stem &= ~pc.match_substring(fresh, token).to_numpy(zero_copy_only=False)
        joined = np.array([t[0] in _blanks and t[-1] not in _blanks for t in texts], bool)
        for group, find in ((~by_stem & joined, self._joined), (~by_stem & ~joined, self.whole)):
            for at in np.array_split(np.flatnonzero(group), -(-int(group.sum()) // 8192) or 1):
                if len(at):
                    slots[new[at]] = memo.put(fresh.take(pa.array(at)), *find([texts[i] for i in at.tolist()]))
        at = np.flatnonzero(by_stem)
        if len(at):
            pairs = pa.array([p for i in at.tolist() for p in (ends[i], texts[i][-marks[i] :])], pa.large_string()).dictionary_encode()
            ids, size = memo.take(self._slots(pairs.dictionary, False)[pairs.indices.to_numpy()])
            slots[new[at]] = memo.put(fresh.take(pa.array(at)), ids, size.reshape(-1, 2).sum(axis=1))
        return slots

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `whole`, of chunks that begin with white space and don't end with it: they are encoded many to a text."""
        ids, _ = self.whole(["".join(chunks[k : k + 64]) for k in range(0, len(chunks), 64)])
        ends = np.cumsum(pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy())
        cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, side="right")
        return ids, np.diff(cuts, prepend=0)
