"""Token ids of whole texts with a public tokenizer, as little-endian bytes.

The word tokenizer drops white space, lowers case and never merges across white space, so the ids of a
text are those of its words one after another. A worker keeps the ids of words it has met in a table
by word hash, where a hit counts only if the bytes agree; a block of texts is split, hashed, looked up
and put together as arrays. New words are
asked of the library: those of Latin letters many at a time, told apart by the end-of-word mark that
each word's last id carries. Texts that hold a special token's opening sign are encoded whole.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LANE, LONG, WordTable, schema_of, text_blocks, tuned

#: Slots of a worker's word table, and ids kept for it; when those are full the table starts anew.
#: Words of letters that a worker keeps besides. Results depend on none of these.
SLOTS, POOL, CORES = 1 << 19, 1 << 21, 80_000
#: ASCII punctuation, but for the apostrophe, which the tokenizer joins with some letters, and the
#: signs of special tokens.
_MARKS = "".join(c for c in string.punctuation if c not in "'<|>")


def goes_by_words(tok, spec: dict) -> bool:
    """Whether a text's ids are those of its words, one after the other: white space only parts words, ASCII marks
    other than those of `split` stand apart from letters, letters lose their case, and a word's last id has a mark."""
    if not spec["model"].get("end_of_word_suffix") or not spec.get("normalizer") or not spec.get("pre_tokenizer"):
        return False
    if spec.get("post_processor") or spec.get("truncation") or spec.get("padding") or spec["model"].get("dropout"):
        return False
    if any(not t["content"].startswith("<|") for t in spec.get("added_tokens", [])):  # texts with `<|` are encoded whole
        return False
    pieces = lambda t: [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(t))]
    if tok.normalizer.normalize_str("\u00c0B \n\t c") != "\u00e0b c":
        return False
    spaced = pieces(" ab \t\ncd\u00a0e ") == pieces("ab") + pieces("cd") + pieces("e") == ["ab", "cd", "e"]
    return spaced and all(pieces(f"{m}ab{m}") == [m, "ab", m] for m in _MARKS)


class WordEncoder:
    """Ids of texts; under a tokenizer that `goes_by_words` those of words are kept, under others texts are encoded whole."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        parsed = json.loads(spec)
        mark = parsed["model"].get("end_of_word_suffix")
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.width = np.dtype("<u2") if max(vocab.values()) < 2**16 else np.dtype("<u4")
        self.by_words = goes_by_words(self.tok, parsed)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        if mark:
            self.last[[i for w, i in vocab.items() if w.endswith(mark)]] = True
        self.cores: dict[str, bytes] = {}
        self.older_cores: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(SLOTS, dtype=np.uint64)
        self.start, self.size = np.zeros(SLOTS, dtype=np.int32), np.zeros(SLOTS, dtype=np.int32)
        self.pool, self.used = np.zeros(1 << 16, dtype=self.width), 0
        # what tells a word from others with its hash: its length, and its lanes where it has more than one
        self.bytes, self.lanes_at = np.zeros(SLOTS, dtype=np.uint8), np.zeros(SLOTS, dtype=np.int32)
        self.lanes, self.lanes_used = np.zeros(1 << 16, dtype=np.uint64), 0

    def plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()

    @staticmethod
    def split(word: str) -> tuple[str, str, str]:
        """(marks, Latin letters, marks), or ("", "", word) where the word is anything else."""
        rest = word.lstrip(_MARKS)
        core = rest.rstrip(_MARKS)
        if core.isalpha():
            if core.isascii():
                return word[: len(word) - len(rest)], core.lower(), rest[len(core) :]
            if max(core) < "\u0250" and core.lower().isalpha():
                return word[: len(word) - len(rest)], core, rest[len(core) :]
        return "", "", word

    def ids_of(self, new: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        cores, old, marks = self.cores, self.older_cores, self.marks
        parts = [self.split(w) for w in new]
        todo: set[str] = set()
        for _, core, _ in parts:
            if core and core not in cores:
                ids = old.get(core)
                if ids is None:
                    todo.add(core)
                else:
                    cores[core] = ids
        ask = list(todo)
        groups = [ask[i : i + 64] for i in range(0, len(ask), 64)]
        got = self.tok.encode_batch([" ".join(g) for g in groups], add_special_tokens=False) if groups else []
        for group, enc in zip(groups, got, strict=True):
            ids = np.array(enc.ids, dtype=self.width)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group):
                raw, at = ids.tobytes(), 0
                for core, end in zip(group, (ends * ids.itemsize).tolist(), strict=True):
                    cores[core] = raw[at:end]
                    at = end
            else:
                for core in group:
                    cores[core] = self.plain(core)
        if len(marks) > 20_000:
            marks.clear()
            marks[""] = b""
        out = []
        for w, (lead, core, tail) in zip(new, parts, strict=True):
            if not core:
                out.append(self.plain(w))
                continue
            for m in (lead, tail):
                if m not in marks:
                    marks[m] = self.plain(m)
            out.append(marks[lead] + cores[core] + marks[tail])
        if len(cores) > CORES:
            self.older_cores, self.cores = cores, {}
        return out

    def met(self, words: WordTable, slot: np.ndarray) -> np.ndarray:
        """Which words the table has: equal hash, length and bytes. Hash and length settle up to eight bytes."""
        hit = (self.key[slot] == words.hash) & (self.bytes[slot] == words.size)
        k, on = 0, np.flatnonzero(hit & (words.size > LANE))
        at = self.lanes_at[slot[on]]
        while len(on):
            good = words.lane(on, k) == self.lanes[at + k]
            hit[on[~good]] = False
            k += 1
            good &= words.size[on] > LANE * k
            on, at = on[good], at[good]
        return hit

    def keep(self, words: WordTable, new: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        """Puts words of up to `LONG` bytes into the table; of those that meet in a slot the last one stays."""
        to = (words.hash[new] & np.uint64(SLOTS - 1)).astype(np.int64)
        _, last = np.unique(to[::-1], return_index=True)
        last = len(to) - 1 - last
        new, to = new[last], to[last]
        self.key[to], self.start[to], self.size[to], self.bytes[to] = words.hash[new], first[last], n[last], words.size[new]
        wide = words.size[new] > LANE
        new, to = new[wide], to[wide]
        count = -(-words.size[new] // LANE)
        at = self.lanes_used + np.cumsum(count) - count
        total = int(count.sum())
        if self.lanes_used + total > len(self.lanes):
            self.lanes = np.concatenate([self.lanes[: self.lanes_used], np.zeros(max(total, self.lanes_used), dtype=np.uint64)])
        self.lanes_at[to] = at
        for k in range(int(count.max(initial=0))):
            on = np.flatnonzero(count > k)
            self.lanes[at[on] + k] = words.lane(new[on], k)
        self.lanes_used += total

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text i are ids[first[i]:first[i + 1]]."""
        words = WordTable(data, offsets)
        if self.used > POOL or self.lanes_used > POOL:
            self.clear()
        slot = (words.hash & np.uint64(SLOTS - 1)).astype(np.int64)
        start, size = self.start[slot], self.size[slot]
        miss = np.flatnonzero(~self.met(words, slot))
        if len(miss):
            _, at, back = np.unique(words.hash[miss], return_index=True, return_inverse=True)
            # each missing word is asked for under the first one with its hash, unless the bytes differ
            alike = words.same(miss, miss[at][back])
            odd = np.flatnonzero(~alike)
            ask = np.concatenate([miss[at], miss[odd]])
            back[odd] = len(at) + np.arange(len(odd))
            raw = self.ids_of([words.word(i).decode("utf-8", "surrogatepass") for i in ask.tolist()])
            n = np.array([len(x) for x in raw], dtype=np.int32) // self.width.itemsize
            more = np.frombuffer(b"".join(raw), dtype=self.width)
            if self.used + len(more) > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(more), self.used), dtype=self.width)])
            self.pool[self.used : self.used + len(more)] = more
            first = (self.used + np.cumsum(n) - n).astype(np.int32)
            self.used += len(more)
            start[miss], size[miss] = first[back], n[back]
            short = np.flatnonzero(words.size[ask] <= LONG)
            self.keep(words, ask[short], first[short], n[short])
        before = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        total = int(before[-1])
        ids = self.pool[np.repeat(start - before[:-1], size) + np.arange(total)]
        return ids, before[words.first]

    def encode_array(self, texts: pa.Array, end: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, rows, ids, first) of runs of texts, each text's ids followed by `end`."""
        e = np.array(end, dtype=self.width)
        for i, n, data, offsets in text_blocks(texts, 1 << 20):
            raw = data.tobytes()
            if not self.by_words or b"<|" in raw:
                rows = [np.frombuffer(self.plain(raw[a:b].decode("utf-8", "surrogatepass")), dtype=self.width) for a, b in zip(offsets, offsets[1:], strict=False)]
                ids, first = np.concatenate([*rows, e[:0]]), np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
            else:
                ids, first = self.block(data, offsets)
            count = np.diff(first)
            out = np.empty(len(ids) + n * len(e), dtype=self.width)
            begin = first + np.arange(n + 1) * len(e)
            out[np.arange(len(ids)) + np.repeat(np.arange(n) * len(e), count)] = ids
            for k, x in enumerate(e):
                out[begin[:-1] + count + k] = x
            yield i, n, out, begin

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids[a:b].tobytes() for _, _, ids, first in self.encode_array(pa.array(texts, pa.string()), []) for a, b in zip(first, first[1:], strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(spec: str) -> WordEncoder:
    """One encoder for each worker process, so that what it has met lasts over tasks."""
    key = str(hash(spec))
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


def tokenised(documents: DataFrame, tokenizer: str, end_id: int, keep: list[str]) -> tuple[DataFrame, np.dtype]:
    """Columns `keep`, n_tokens long and ids binary: the whole text's ids (null: none), then `end_id`.

    `tokenizer` is the path of a tokenizer file on the driver; workers get its content.
    """
    spark = tuned(documents.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    spec = spark.sparkContext.broadcast(text)
    top = max(max(json.loads(text)["model"]["vocab"].values()), max([x["id"] for x in json.loads(text).get("added_tokens", [])], default=0), end_id)
    width = np.dtype("<u2") if top < 2**16 else np.dtype("<u4")
    picked = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = [picked.schema[c] for c in keep]
    out = schema_of("n_tokens long, ids binary")
    for f in reversed(fields):
        out.fields.insert(0, f)
        out.names.insert(0, f.name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(spec.value)
        for b in batches:
            for i, n, ids, first in enc.encode_array(b.column("_text"), [end_id]):
                ids = ids.astype(width, copy=False)
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((first * width.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, n) for c in keep], pa.array(np.diff(first), pa.int64()), binary], names=[*keep, "n_tokens", "ids"])

    return picked.mapInArrow(run, out), width
