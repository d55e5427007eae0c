"""Token ids in binary files: Simple-8b words in blocks, with escapes, offsets of blocks and an index of documents."""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docforge.llm.common import ensure_checkpoint_dir, map_arrow, written

#: Values in a word by selector; each has 60 // count bits. Selector 0 is never written, 15 is an escape.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
WIDTHS = np.array([0] + [60 // int(c) for c in COUNTS[1:]], np.int64)
ESCAPE = 15
#: Ids of a block. Only a shard's last block has fewer.
BLOCK = 1024
#: Blocks that are coded or decoded at once.
RUN = 1024
#: A shard ends with the document that takes it to this many ids or documents.
SHARD_IDS, SHARD_DOCS = 1 << 25, 1 << 20
#: Most tasks that read files.
READERS = 10_000
MAGIC = b"s8bids01"
#: Different parts of texts whose ids a worker remembers (and half as many pieces of these), and the longest in characters.
REMEMBERED, LONGEST = 1 << 20, 64
#: What str.isspace or a tokenizer takes for a blank.
BLANK = frozenset(c for c in map(chr, range(0x3001)) if c.isspace() or c == "\u180e")
MARKS = frozenset(".,;:!?")
#: Pieces of a text that end where a byte-level pre-tokenizer always cuts: words before blanks and marks, marks before
#: blanks, letters and digits, a single line feed between words, and all else up to the next blank between two characters.
PIECE = re.compile(r" ?[A-Za-z]++(?![^ \n.,;:!?])|[.,;:!?]++(?![^\sA-Za-z0-9])|\n(?=[A-Za-z])|[\s\S]+?(?=(?<=[^\s\u180e])[ \n][^\s\u180e]|\Z)")


#: Bit lengths of what fits 16 bits.
SHORT = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return SHORT[values.astype(np.uint16)]
    high, low = (values >> np.uint64(32)).astype(np.float64), (values & np.uint64(0xFFFFFFFF)).astype(np.float64)  # both exact
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.uint8)


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block with the total at the end) of uint64 ``ids``.

    A block is one word that holds its counts (ids in the low 32 bits, escapes in the high ones), packed words, and
    escapes as plain words. Each packed word takes as many of the next ids as fit: selector in the top four bits, then
    values from the lowest bits on. An id of over 60 bits is an escape. All blocks are packed in step.
    """
    n = len(ids)
    blocks = -(-n // block)
    padded = np.zeros((blocks, block + 60), np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = ids
    padded[:, :block] = flat.reshape(blocks, block)
    sizes = np.full(blocks, block, np.int64)
    if blocks and n % block:
        sizes[-1] = n % block
    values = padded.reshape(-1)
    bits = bit_lengths(values)
    # the best selector at each place: the largest count whose widest value fits
    best = np.full(len(values), ESCAPE, np.uint8)
    widest, reach = bits, 1
    for selector in range(14, 0, -1):
        count = int(COUNTS[selector])
        while reach < count:
            step = min(reach, count - reach)
            widest = np.concatenate([np.maximum(widest[:-step], widest[step:]), widest[-step:]])
            reach += step
        np.copyto(best, np.uint8(selector), where=widest <= WIDTHS[selector])
    begins = np.zeros(len(values), bool)  # where a word's first value stands
    place, alive = np.zeros(blocks, np.int64), np.arange(blocks)
    base = np.arange(blocks, dtype=np.int64) * (block + 60)
    while len(alive):
        at = base[alive] + place[alive]
        begins[at] = True
        place[alive] += COUNTS[best[at]]
        alive = alive[place[alive] < sizes[alive]]
    where = np.flatnonzero(begins)
    which = where // (block + 60)
    chosen = best[where].astype(np.int64)
    packed = chosen.astype(np.uint64) << np.uint64(60)
    for selector in range(1, ESCAPE):
        mine = np.flatnonzero(chosen == selector)
        word = packed[mine]
        for k in range(int(COUNTS[selector]) if len(mine) else 0):
            word |= values[where[mine] + k] << np.uint64(k * int(WIDTHS[selector]))
        packed[mine] = word
    escaped = chosen == ESCAPE
    n_words, n_escapes = np.bincount(which, minlength=blocks), np.bincount(which[escaped], minlength=blocks)
    starts = np.concatenate([[0], np.cumsum(1 + n_words + n_escapes)]).astype(np.int64)
    words = np.zeros(int(starts[-1]), np.uint64)
    words[starts[:-1]] = sizes.astype(np.uint64) | (n_escapes.astype(np.uint64) << np.uint64(32))
    rank = np.arange(len(which)) - (np.cumsum(n_words) - n_words)[which]
    words[starts[which] + 1 + rank] = packed
    theirs = which[escaped]
    rank = np.arange(len(theirs)) - (np.cumsum(n_escapes) - n_escapes)[theirs]
    words[starts[theirs] + 1 + n_words[theirs] + rank] = values[where[escaped]]
    return words, starts


def decode(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of whole blocks that begin at ``starts[:-1]``; ``starts[-1]`` is their end."""
    heads = words[starts[:-1]]
    sizes, n_escapes = (heads & np.uint64(0xFFFFFFFF)).astype(np.int64), (heads >> np.uint64(32)).astype(np.int64)
    n_words = np.diff(starts) - 1 - n_escapes
    total = int(n_words.sum())
    blocks = np.repeat(np.arange(len(sizes)), n_words)
    at = starts[:-1][blocks] + 1 + np.arange(total) - (np.cumsum(n_words) - n_words)[blocks]
    packed = words[at]
    selectors = (packed >> np.uint64(60)).astype(np.int64)
    if (selectors == 0).any():
        raise ValueError("a word without a selector: the file is damaged")
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    begin = ends - counts
    first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    inside = begin - begin[first][blocks] if total else begin  # place in the block
    base = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(base[-1]) + 60, np.uint64)
    target = base[:-1][blocks] + inside
    limit = base[1:][blocks]
    for selector in range(1, ESCAPE):
        mine = np.flatnonzero(selectors == selector)
        mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
        for k in range(int(COUNTS[selector]) if len(mine) else 0):
            to = target[mine] + k
            good = to < limit[mine]  # the last word of a block may hold fewer
            out[to[good]] = (packed[mine[good]] >> np.uint64(k * int(WIDTHS[selector]))) & mask
    escaped = np.flatnonzero(selectors == ESCAPE)
    theirs = blocks[escaped]
    rank = np.arange(len(escaped)) - (np.cumsum(n_escapes) - n_escapes)[theirs]
    out[target[escaped]] = words[starts[:-1][theirs] + 1 + n_words[theirs] + rank]
    return out[: int(base[-1])]


class ShardWriter:
    """One file: MAGIC, blocks, then offsets of blocks, ids and sizes of documents, and a tail that says where they are."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.system, self.path = system, path
        self.out = system.open_output_stream(path)
        self.out.write(MAGIC)
        self.offsets, self.doc_ids, self.missing, self.sizes = [np.zeros(1, np.int64)], [], [], []
        self.held, self.n_held, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document and its ids, four bytes each."""
        n = len(ids) // 4
        self.doc_ids.append(doc_id or 0)
        self.missing.append(doc_id is None)
        self.sizes.append(n)
        self.held.append(ids)
        self.n_held += n
        self.n_ids += n
        if self.n_held >= BLOCK * RUN:
            self._flush(self.n_held - self.n_held % BLOCK)

    def _flush(self, upto: int) -> None:
        ids = np.frombuffer(b"".join(self.held), np.uint32)
        for i in range(0, upto, BLOCK * RUN):
            words, starts = encode(ids[i : min(upto, i + BLOCK * RUN)].astype(np.uint64))
            self.out.write(words.astype("<u8").tobytes())
            self.offsets.append(self.offsets[-1][-1] + starts[1:])
        self.held, self.n_held = [ids[upto:].tobytes()], len(ids) - upto

    def close(self) -> tuple[str, int, int]:
        """(file name, documents, ids)"""
        self._flush(self.n_held)
        offsets = np.concatenate(self.offsets)
        for part, kind in ((offsets, "<i8"), (self.doc_ids, "<i8"), (self.missing, "u1"), (self.sizes, "<i8")):
            self.out.write(np.asarray(part).astype(kind).tobytes())
        self.out.write(struct.pack("<qqq", len(offsets) - 1, len(self.sizes), self.n_ids) + MAGIC)
        self.out.close()
        return os.path.basename(self.path), len(self.sizes), self.n_ids


class ShardReader:
    """Random access to a shard: any run of ids is read and decoded by its blocks alone."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(32, size - 32)
        if tail[-8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no file of ids")
        n_blocks, n_docs, self.n_ids = struct.unpack("<qqq", tail[:24])
        length = 8 * (n_blocks + 1) + 17 * n_docs
        index = self.file.read_at(length, size - 32 - length)
        self.offsets = np.frombuffer(index, "<i8", n_blocks + 1)
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1))
        self.missing = np.frombuffer(index, "u1", n_docs, 8 * (n_blocks + 1) + 8 * n_docs).astype(bool)
        self.sizes = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1) + 9 * n_docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``, counted from the shard's first."""
        if start >= stop:
            return np.zeros(0, np.uint64)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        begin, end = int(self.offsets[first]), int(self.offsets[last + 1])
        words = np.frombuffer(self.file.read_at(8 * (end - begin), len(MAGIC) + 8 * begin), "<u8")
        return decode(words, self.offsets[first : last + 2] - begin)[start - first * BLOCK : stop - first * BLOCK]

    def runs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(first id's place, ids) of runs of RUN blocks."""
        for start in range(0, self.n_ids, BLOCK * RUN):
            yield start, self.ids(start, min(self.n_ids, start + BLOCK * RUN))


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def cuts_at_words(definition: str) -> bool:
    """Whether a tokenizer's definition is byte-level without normalisation, so that no token reaches over a PIECE's end."""
    known = json.loads(definition)
    before = known.get("pre_tokenizer") or {}
    special = known.get("added_tokens") or []
    plain = not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or re.search(r"[\s.,;:!?]", a["content"]) or a["content"].isalpha() for a in special)
    return before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not known.get("normalizer") and plain


def byte_letters() -> dict[int, str]:
    """What byte-level models read for each byte: printable characters of Latin-1 stand for themselves, the others for the
    characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts. What stands between sure cuts is encoded once and remembered; other tokenizers get whole texts.

    A text is cut before each blank between two characters that are no blanks. Of each new part its PIECEs are looked up,
    and of each new piece its ids are made: a piece of letters, digits or marks alone, after a blank or not, is one word
    to the pre-tokenizer, so that the tokenizer's model gets it at once. When too many parts or pieces are known, all are forgotten.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_pieces = cuts_at_words(definition)
        self.letters, self.model = byte_letters(), self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _word(self, piece: str) -> bytes:
        """The ids of what is one word to the pre-tokenizer."""
        shown = piece.replace(" ", self.letters[32]) if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        if len(self.pieces) > REMEMBERED // 2:
            self.pieces.clear()
        others = []
        for p in pieces:
            word = p[1:] if p[0] == " " else p
            b = self.parts.get(word) if p[0] == " " else None
            if b is not None:
                self.pieces[p] = b
            elif word.isalpha() or word.isdecimal() or MARKS.issuperset(word) and word:
                self.pieces[p] = self._word(p)
            else:
                others.append(p)
        if others:
            for p, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
                self.pieces[p] = array("I", e.ids).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The ids of each text by its pieces."""
        pieces = [PIECE.findall(t) for t in texts]
        new = {p for own in pieces for p in own if p not in self.pieces}
        if new:  # if it takes forgetting, then all are new
            self._learn(new if len(self.pieces) <= REMEMBERED // 2 else {p for own in pieces for p in own})
        get = self.pieces.__getitem__
        return [get(own[0]) if len(own) == 1 else b"".join(map(get, own)) for own in pieces]

    def encode(self, text: str) -> bytes:
        """A text's ids, four bytes each."""
        if not self.by_pieces:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *parts = text.split(" ")
        known = list(map(self.parts.get, parts))
        new = {p for p, b in zip(parts, known, strict=True) if b is None} if None in known else set()
        # beside a part that is empty or has a blank at an end there is no sure cut
        if any(not p or p[0] in BLANK or p[-1] in BLANK for p in new) or parts and (not first or first[-1] in BLANK):
            return self._whole([text])[0]
        made = {p: self._word(f" {p}") for p in new if p.isalpha()}
        others = [p for p in new if p not in made]
        opening, *ids = self._whole([first, *(f" {p}" for p in others)])
        made.update(zip(others, ids, strict=True))
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        self.parts.update(made if max(map(len, made), default=0) <= LONGEST else {p: b for p, b in made.items() if len(p) <= LONGEST})
        return opening + b"".join([made[p] if b is None else b for p, b in zip(parts, known, strict=True)])


@lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    """A worker's encoder: what it remembers serves all tasks that the worker gets."""
    return Encoder(definition)


def write_ids(df: DataFrame, tokenizer: str, folder: str | None = None, text: str = "text", doc_id: str = "doc_id", end_id: int = 2) -> DataFrame:
    """Write the ids of every text, each followed by ``end_id``, to files in ``folder``; returns their manifest.

    ``tokenizer`` is a definition file of the tokenizers library, read on the driver. Documents go in ascending order of
    doc_id, null first; rows that repeat one follow by a hash of their texts. A null text is an empty one: its end id alone.
    The manifest (part, shard, file, docs, ids) says which files count, in order: one that a lost task left isn't in it,
    and is removed at the end. Texts are shuffled once, by ranges of the id; a task holds one text's ids and a run of
    blocks at a time. Extra columns are ignored; an empty table gives no files.
    """
    spark = df.sparkSession
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/ids-{uuid.uuid4().hex}"
    system, place = _system(folder)
    system.create_dir(place)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = encoder(definition.value).encode, struct.pack("=I", end_id), TaskContext.get().partitionId()
        target, where = _system(folder)
        shard, done = None, 0

        def row(closed: tuple[str, int, int]) -> pa.RecordBatch:
            arrays = [pa.array([part], pa.int32()), pa.array([done], pa.int32()), *(pa.array([x]) for x in closed)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "shard", "file", "docs", "ids"])

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shard is None:
                    shard = ShardWriter(target, f"{where}/part-{part:06d}-{done:06d}-{uuid.uuid4().hex}.s8b")
                shard.add(key, encode(value.as_py() or "") + end)
                if shard.n_ids >= SHARD_IDS or len(shard.sizes) >= SHARD_DOCS:
                    yield row(shard.close())
                    shard, done = None, done + 1
        if shard is not None:
            yield row(shard.close())

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = source.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h")
    manifest = written(map_arrow(ordered.select("doc_id", "text"), run, "part int, shard int, file string, docs long, ids long"))
    sound = {r.file for r in manifest.select("file").toLocalIterator()}
    for info in system.get_file_info(fs.FileSelector(place)):
        if info.base_name not in sound:
            system.delete_file(info.path)
    return manifest.withColumn("folder", F.lit(folder))


def _placed(manifest: DataFrame) -> DataFrame:
    """The manifest's files with the ids before each, dealt out over as many tasks as there are files, READERS at most."""
    before = F.sum("ids").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("folder", "file", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.repartition(max(1, min(READERS, manifest.count())), F.xxhash64("file"))


def read_counts(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read back from the files: a document's place, size and checksum.

    The checksum is of its ids as little-endian unsigned 32-bit integers. Files are read in runs of blocks, so a document
    of any length takes the memory of a run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _system(row["folder"])
                shard = ShardReader(system, f"{place}/{row['file']}")
                ends = np.cumsum(shard.sizes)
                checks, doc = np.zeros(len(ends), np.int64), 0
                for start, ids in shard.runs():
                    data = ids.astype("<u4").tobytes()
                    at, stop = start, start + len(ids)
                    while at < stop:
                        upto = min(stop, int(ends[doc]))
                        checks[doc] = zlib.crc32(data[4 * (at - start) : 4 * (upto - start)], int(checks[doc]))
                        at = upto
                        doc += at == ends[doc]
                arrays = [pa.array(shard.doc_ids, mask=shard.missing), pa.array(row["before"] + ends - shard.sizes), pa.array(shard.sizes), pa.array(checks)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(_placed(manifest), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, ids) read back from the files; a row holds its document's ids whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _system(row["folder"])
                shard = ShardReader(system, f"{place}/{row['file']}")
                begin = 0
                for key, gone, size in zip(shard.doc_ids.tolist(), shard.missing.tolist(), shard.sizes.tolist(), strict=True):
                    ids = pa.array([shard.ids(begin, begin + size).view(np.int64)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([None if gone else key], pa.int64()), pa.array([row["before"] + begin]), ids], names=["doc_id", "start", "ids"])
                    begin += size

    return map_arrow(_placed(manifest), run, "doc_id long, start long, ids array<long>")
