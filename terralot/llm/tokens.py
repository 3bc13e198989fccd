"""Encoding whole texts with public vocabularies, a batch at a time.

A text is cut before each space that follows a character other than white space. No match of
the vocabularies' pattern crosses such a place and none looks behind, so encoding the chunks one
by one gives what encoding the text gives. Texts with white space before a space are encoded whole.
The distinct chunks of a batch are looked up once, new ones are encoded together, and the ids of
all chunks are gathered by their places; nothing is done per word of a text in Python.
"""

from __future__ import annotations

import array
import os
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNSURE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
#: Letters of the first 256 characters: on these all Unicode versions agree.
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
#: Marks that end a chunk as a match of their own after its letters.
MARKS = ".,;:!?*$%&#"
Encoded = tuple[np.ndarray, np.ndarray]


def joined(parts: list[list[int]]) -> Encoded:
    """Lists of ids as one array and the count of each."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(array.array("I", [i for x in parts for i in x]), np.uint32), sizes


class Pool:
    """Pieces of ids, each known by its slot."""

    def __init__(self):
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Slots for new pieces, given all their ids and the count of each."""
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(sizes) > len(self.start):
            self.start, self.size = np.concatenate([self.start, np.zeros_like(self.start)]), np.concatenate([self.size, np.zeros_like(self.size)])
        at = slice(self.n, self.n + len(sizes))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.start[at], self.size[at] = self.n_ids + np.cumsum(sizes) - sizes, sizes
        self.n, self.n_ids = self.n + len(sizes), self.n_ids + len(ids)
        return np.arange(at.start, at.stop)

    def gather(self, slots: np.ndarray) -> Encoded:
        """The ids of these pieces one after the other, and where each ends."""
        return taken(self.ids, self.start[slots], self.size[slots])


def taken(ids: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> Encoded:
    """The runs of ids that begin at `start`, one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


class ChunkEncoder:
    """An array of texts -> (all ids, unsigned 32-bit; where each text's begin and, last, where they end).

    encode_chunks gives the ids of chunks that follow a space (which the strings given lack), encode_texts
    those of strings by themselves. Chunks of up to `longest` characters are kept in two generations: when the younger
    has more than `entries`, it becomes the elder, and those of the elder that were not met again are forgotten.
    Letters with marks after them are two matches, so their letters are looked up alone.
    """

    def __init__(self, encode_chunks: Callable[[pa.Array], Encoded], encode_texts: Callable[[list[str]], Encoded], whole: bool = False, entries: int = 300_000, longest: int = 48):
        self.encode_chunks, self.encode_texts, self.whole, self.entries, self.longest = encode_chunks, encode_texts, whole, entries, longest
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.pool = Pool()
        self.elder: tuple[dict[str, int], Pool] = {}, self.pool

    def age(self) -> None:
        elder = self.slots, self.pool
        self.forget()
        self.elder = elder

    def find(self, words: list[str]) -> np.ndarray:
        """Slots of the chunks that are kept, -1 for others; those of the elder generation are young again."""
        slots = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        of_elder, pool = self.elder
        if of_elder:
            lacking = np.flatnonzero(slots < 0)
            asked = [words[i] for i in lacking.tolist()]
            elder = np.fromiter(map(of_elder.get, asked, repeat(-1)), np.int64, len(asked))
            met = np.flatnonzero(elder >= 0)
            ids, ends = pool.gather(elder[met])
            slots[lacking[met]] = again = self.pool.add(ids, np.diff(ends, prepend=0))
            self.slots.update(zip([asked[i] for i in met.tolist()], again.tolist()))
        return slots

    def keep(self, words: list[str], new: pa.Array) -> np.ndarray:
        """Slots of chunks that are not kept yet."""
        slots = self.pool.add(*self.encode_chunks(new))
        self.slots.update(zip(words, slots.tolist()))
        return slots

    def learn(self, words: list[str], new: pa.Array) -> np.ndarray:
        """Slots of chunks met for the first time; they are kept."""
        cut = pc.replace_substring_regex(new, f"^([{LATIN}]+)([{MARKS}]+)$", "\\1\0\\2")
        whole = pc.binary_length(cut).to_numpy() == pc.binary_length(new).to_numpy()
        plain, marked = np.flatnonzero(whole), np.flatnonzero(~whole)
        slots = np.zeros(len(words), np.int64)
        slots[plain] = self.keep([words[i] for i in plain.tolist()], new.take(pa.array(plain)))
        halves = pc.split_pattern(cut.take(pa.array(marked)), "\0").values.to_numpy(zero_copy_only=False).tolist()
        bodies, tails = halves[::2], halves[1::2]
        distinct = list(dict.fromkeys(bodies))
        at = self.find(distinct)
        lacking = np.flatnonzero(at < 0)
        asked = [distinct[i] for i in lacking.tolist()]
        at[lacking] = self.keep(asked, pa.array(asked, pa.string()))
        body_at = dict(zip(distinct, at.tolist()))
        asked = [x for x in dict.fromkeys(tails) if x not in self.tails]
        self.tails.update(zip(asked, self.pool.add(*self.encode_texts(asked)).tolist()))
        pairs = np.empty(len(halves), np.int64)
        pairs[::2] = np.fromiter(map(body_at.__getitem__, bodies), np.int64, len(bodies))
        pairs[1::2] = np.fromiter(map(self.tails.__getitem__, tails), np.int64, len(tails))
        ids, ends = self.pool.gather(pairs)
        slots[marked] = self.pool.add(ids, np.diff(ends[1::2], prepend=0))
        self.slots.update(zip([words[i] for i in marked.tolist()], slots[marked].tolist()))
        return slots

    def encode(self, texts: pa.Array) -> Encoded:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self.slots) > self.entries:
            self.age()
        pool = self.pool
        alone = np.ones(len(texts), bool) if self.whole else pc.match_substring_regex(texts, UNSURE).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.if_else(pa.array(alone), "", texts), " ")
        bounds, coded = cut.offsets.to_numpy().astype(np.int64), cut.values.dictionary_encode()
        index, names = coded.indices.to_numpy(), coded.dictionary
        first, slot_of = bounds[:-1], np.full(len(names), -1, np.int64)
        after = np.ones(len(index), bool)
        after[first] = False
        slot_of[index[after]] = 0
        places = np.flatnonzero(slot_of == 0)
        words = names.take(pa.array(places)).to_numpy(zero_copy_only=False).tolist()
        slots = self.find(words)
        new = np.flatnonzero(slots < 0)
        kept = new[pc.binary_length(names).to_numpy()[places[new]] <= self.longest]
        slots[kept] = self.learn([words[i] for i in kept], names.take(pa.array(places[kept])))
        known = pool.n, pool.n_ids  # what follows is of this batch only
        long = np.flatnonzero(slots < 0)
        slots[long] = pool.add(*self.encode_chunks(names.take(pa.array(places[long]))))
        slot_of[places] = slots
        slot = slot_of[index]
        for where, source in ((np.flatnonzero(~alone), names.take(pa.array(index[first[~alone]]))), (np.flatnonzero(alone), texts.filter(pa.array(alone)))):
            strings = source.to_numpy(zero_copy_only=False).tolist()
            distinct = dict.fromkeys(strings)
            distinct = dict(zip(distinct, pool.add(*self.encode_texts(list(distinct))).tolist()))
            slot[first[where]] = [distinct[x] for x in strings]
        ids, ends = pool.gather(slot)
        pool.n, pool.n_ids = known
        return ids, np.concatenate([[0], ends])[bounds]


def with_end(encoded: Encoded, end_id: int) -> Encoded:
    """The same with an id more after each text's."""
    ids, bounds = encoded
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def as_binary(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each text's ids as little-endian bytes, two or four an id."""
    wide = ids.astype("<u2") if not len(ids) or ids.max() < 65536 else ids.astype("<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64) * wide.itemsize), pa.py_buffer(wide)]).cast(pa.binary())


_encoders: dict[str, ChunkEncoder] = {}


def library_encoder(path: str) -> ChunkEncoder:
    """Encodes with the tokenizers library; strings of special tokens in a text are ordinary text. One encoder a process.

    Chunks of letters are matches of the pattern as they are, so the library's model gets them without its
    pattern; others go through the whole library. Many chunks are encoded as one
    string: each holds one space, its first byte, so a token that begins with a space begins a chunk.
    Only byte-level vocabularies with the common pattern are cut into chunks; texts for others are encoded whole.
    """
    if path in _encoders:
        return _encoders[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(path)
    full.encode_special_tokens = True
    whole = full.normalizer is not None or repr(full.pre_tokenizer) != "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
    tokenize = full.model.tokenize
    # the vocabulary writes printable bytes as themselves and the others as the characters from 256 on
    printable = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    space = letter[32]
    letter[0] = " "  # between chunks
    vocabulary = full.get_vocab()
    opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    opens[[i for token, i in vocabulary.items() if token[0] == space]] = True

    def texts(strings: list[str]) -> Encoded:
        return joined([e.ids for e in full.encode_batch_fast(strings, add_special_tokens=False)])

    def by_space(ids: list[int], n: int) -> Encoded:
        made = np.frombuffer(array.array("I", ids), np.uint32)
        begin = np.flatnonzero(opens[made]) if n else np.zeros(0, np.int64)
        if len(begin) != n:
            raise ValueError(f"{n} chunks gave {len(begin)}")
        return made, np.diff(begin, append=len(made))

    def of_letters(words: list[str]) -> Encoded:
        mapped = (" " + "\0 ".join(words)).encode().decode("latin-1").translate(letter).split(" ") if words else []
        return by_space([token.id for x in mapped for token in tokenize(x)], len(words))

    def together(words: list[str]) -> Encoded:
        return by_space(full.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids if words else [], len(words))

    def chunks(new: pa.Array) -> Encoded:
        letters = pc.match_substring_regex(new, f"^[{LATIN}]+$").to_numpy(zero_copy_only=False)
        fine = ~letters & pc.match_substring_regex(new, r"^[^\s\x0b\x1c-\x1f\x{85}\p{Z}](?s:.*[^\s\x0b\x1c-\x1f\x{85}\p{Z}])?$").to_numpy(zero_copy_only=False)
        strings = lambda which: new.filter(pa.array(which)).to_numpy(zero_copy_only=False).tolist()
        made = [
            (letters, of_letters(strings(letters))),
            (fine, together(strings(fine))),
            (~letters & ~fine, texts([" " + x for x in strings(~letters & ~fine)])),
        ]
        order = np.argsort(np.concatenate([np.flatnonzero(which) for which, _ in made]))
        sizes = np.concatenate([n for _, (_, n) in made])
        start = (np.cumsum(sizes) - sizes)[order]
        return taken(np.concatenate([x for _, (x, _) in made]), start, sizes[order])[0], sizes[order]

    _encoders[path] = ChunkEncoder(chunks, texts, whole)
    return _encoders[path]


def forget_chunks() -> None:
    """Empty this process's encoders, for tasks of a later stage that encode nothing."""
    for encoder in _encoders.values():
        encoder.forget()


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
