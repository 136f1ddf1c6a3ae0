"""Token-id output with bit-plane shuffling.

Documents are encoded with a public tokenizer, one end id is appended to each, and
the id stream in ascending ``doc_id`` order is cut into *segments* of whole
documents.  A segment holds blocks of ``block`` ids (the last one shorter); a block
is transposed into four byte planes (or 32 bit planes) of its unsigned 32-bit ids,
and each plane is compressed by itself with zstandard.  Planes of high bytes are
nearly constant, so they vanish.

The files are Parquet with one row per segment, written by Spark's own writer (any
file system, atomic commit, lost executors):

``shard, seg, first_id, n_ids, doc_ids, lengths, plane_bits, block, sizes, payload``

``sizes`` is the chunk index: the compressed size of every plane, block after block,
so any block can be read by itself; ``first_id`` counts ids inside the shard.

Cases: null text is empty (only the end id); rows with equal or null ``doc_id``
stay separate rows, nulls first, ties in order of the hash of the text, then the text; an empty table gives an
empty output; other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, partitions_for, setting, stored, text_slices

BLOCK = 1 << 16
SEGMENT = 1 << 20
SEGMENT_SCHEMA = ("shard int, seg long, first_id long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
                  "plane_bits int, block int, sizes array<int>, payload binary")
INDEX_SCHEMA = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
CACHE_PIECES = 300_000
SLICE = 4 << 20
BATCH_ROWS = 1000
# letters and then signs but no apostrophe: a border of the tokenizer's own splits
_LETTERS = re.compile(rb"[a-z\x80-\xff]+")
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
# byte-level vocabularies write a byte that is no visible Latin-1 character as one from U+0100 on; spaces stay
_BYTE_CHARS = np.arange(256, dtype="<u4")
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTE_CHARS[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
_BYTE_CHARS[32] = 32


def _values(texts: pa.Array) -> list[bytes]:
    """The strings of a dictionary."""
    offs, raw = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].tolist(), texts.buffers()[2]
    raw = raw.to_pybytes() if raw is not None else b""
    return [raw[a:b] for a, b in zip(offs, offs[1:])]


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    For tokenizers that drop white space and never join over it: a text's ids are
    those of its words one after another, so the different words of some ``SLICE``
    bytes of text are encoded once and their ids dealt out by index.  A word of
    letters and then signs is two such pieces where the tokenizer splits there;
    pieces are remembered over slices (``CACHE_PIECES`` at most, then the memory
    starts afresh), whole words are not: most of them are rare.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[bytes, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        lowers = {"type": "Lowercase"} in ((spec.get("normalizer") or {}).get("normalizers") or [])
        suffix = spec["model"].get("end_of_word_suffix")
        self.splits_signs = bool(suffix) and lowers and splits[-1].get("type") == "ByteLevel" and splits[0].get("pattern", {}).get("Regex", "").endswith(
            r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        if self.splits_signs:
            self.letters = Tokenizer(self.tokenizer.model)      # the same model; its words come normalised and in byte characters
            self.letters.pre_tokenizer = WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab(False)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _runs(self, text: str, n: int) -> list[bytes | None]:
        """Ids of the ``n`` words, in byte characters, of a text; None for all if they are not one piece each."""
        ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)] if len(ends) == n else [None] * n

    def _letters(self, runs: list[bytes]) -> dict[bytes, bytes | None]:
        """Ids of runs of letters; None for one that is not such a run to this tokenizer."""
        plain = [r for r in runs if r.isascii()]
        out: dict[bytes, bytes | None] = dict.fromkeys(runs)
        out.update(zip(plain, self._runs(b" ".join(plain).decode(), len(plain))))
        texts = {r: t for r in runs if not r.isascii() and (t := r.decode("utf-8", "replace")).isalpha()}
        if texts:   # letters hold no white space, so the words of the joined text are the runs
            named = dict(zip(texts, self.tokenizer.normalizer.normalize_str(" ".join(texts.values())).split(" ")))
            named = {r: t for r, t in named.items() if t.isalpha()}
            text = _BYTE_CHARS[np.frombuffer(" ".join(named.values()).encode(), np.uint8)].tobytes().decode("utf-32-le")
            out.update(zip(named, self._runs(text, len(named))))
        return out

    def _whole(self, words: list[bytes]) -> list[bytes]:
        got = [e.ids for a in range(0, len(words), 20_000) for e in self.tokenizer.encode_batch_fast(
            [w.decode("utf-8", "replace") for w in words[a:a + 20_000]], add_special_tokens=False)]
        return [np.array(ids, "<u4").tobytes() for ids in got]

    def _words(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of some pieces, and for each of the different ``words`` the two pieces it is made of."""
        texts = _values(words)
        if not self.splits_signs:
            return [b"", *self._whole(texts)], np.stack([np.arange(1, len(texts) + 1), np.zeros(len(texts), np.int64)], axis=1)
        pieces = self.pieces
        if len(pieces) > CACHE_PIECES:
            pieces.clear()
        core = pc.ascii_lower(pc.ascii_rtrim(words, characters=_SIGNS))
        size = pc.binary_length(core).to_numpy()
        signs = pc.binary_length(words).to_numpy() - size
        found = core.dictionary_encode()
        runs = _values(found.dictionary)
        letters = np.array([_LETTERS.fullmatch(r) is not None for r in runs], bool)
        new = [r for r, ok in zip(runs, letters) if ok and r not in pieces]
        for a in range(0, len(new), 2000):
            pieces.update(self._letters(new[a:a + 2000]))
        ids = [pieces[r] if ok else None for r, ok in zip(runs, letters)]
        known = np.array([x is not None for x in ids], bool)[found.indices.to_numpy()]
        pair = np.stack([found.indices.to_numpy().astype(np.int64), np.full(len(texts), len(ids))], axis=1)
        ids = [x or b"" for x in ids] + [b""]
        signed = np.flatnonzero(known & (signs > 0))
        tails = [texts[i][-n:] for i, n in zip(signed.tolist(), signs[signed].tolist())]
        place = {x: len(ids) + j for j, x in enumerate(dict.fromkeys(tails))}
        pair[signed, 1] = [place[x] for x in tails]
        ids += self._whole(list(place))
        rest = np.flatnonzero(~known).tolist()
        pair[rest, 0] = np.arange(len(ids), len(ids) + len(rest))
        return ids + self._whole([texts[i] for i in rest]), pair

    def _slice(self, texts: list[bytes]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string(), safe=False))
        found = words.flatten().dictionary_encode()
        if not len(found):
            return [b""] * len(texts)
        ids, pair = self._words(found.dictionary)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        use = pair[found.indices.to_numpy()].reshape(-1)
        n = size[use]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(size) - size)[use] - (ends - n), n) + np.arange(ends[-1])
        got = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        bounds = (np.concatenate([[0], ends[1::2]])[words.offsets.to_numpy()] * 4).tolist()
        return [got[a:b] for a, b in zip(bounds, bounds[1:])]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held, owners, size = [], [], 0
        for i, text in enumerate(texts):
            a = 0
            while a < len(text):                 # a long text in parts that end before white space
                space = _SPACE.search(text, a + SLICE)
                b = space.start() if space else len(text)
                held.append(text[a:b])
                owners.append(i)
                size += b - a
                a = b
                if size >= SLICE:
                    for j, got in zip(owners, self._slice(held)):
                        out[j].append(got)
                    held, owners, size = [], [], 0
        for j, got in zip(owners, self._slice(held) if held else ()):
            out[j].append(got)
        return [b"".join(x) for x in out]


class WholeEncoder:
    """Ids of whole texts, for tokenizers whose tokens may hold white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]


_ENCODERS: dict = {}


def encoder(path: str, by_word: bool):
    """One encoder per Python worker and tokenizer file."""
    if (path, by_word) not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path, by_word] = (WordEncoder if by_word else WholeEncoder)(path)
    return _ENCODERS[path, by_word]


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block of uint32 ids: 4 byte planes (bits=8) or 32 bit planes (bits=1)."""
    rows = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [np.ascontiguousarray(rows[:, j]).tobytes() for j in range(4)]
    flat = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(flat[:, j], bitorder="little").tobytes() for j in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    if bits == 8:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    flat = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(flat, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack(ids: np.ndarray, block: int, bits: int, level: int = 3) -> tuple[list[int], bytes]:
    """Compressed planes of all blocks, one after another, and their sizes."""
    press = zstandard.ZstdCompressor(level=level)
    done = [press.compress(p) for a in range(0, len(ids), block) for p in to_planes(ids[a:a + block], bits)]
    return [len(x) for x in done], b"".join(done)


def unpack(sizes: Iterable[int], payload: bytes, n_ids: int, block: int, bits: int) -> np.ndarray:
    open_ = zstandard.ZstdDecompressor()
    per, at, planes, out = (4 if bits == 8 else 32), 0, [], []
    for size in sizes:
        planes.append(open_.decompress(payload[at:at + size]))
        at += size
        if len(planes) == per:
            n = min(block, n_ids - block * len(out))
            out.append(from_planes(planes, n, bits))
            planes = []
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def write_tokens(docs: DataFrame, name: str, tokenizer: str, end_id: int = 1, by_word: bool = True,
                 id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                 segment: int = SEGMENT, plane_bits: int = 8) -> DataFrame:
    """Encode ``docs`` in ascending id order and write the segment files; returns them read back."""
    schema = pa.schema([("shard", pa.int32()), ("seg", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("plane_bits", pa.int32()),
                        ("block", pa.int32()), ("sizes", pa.list_(pa.int32())), ("payload", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer, by_word), TaskContext.get().partitionId()
        seg, first = 0, 0
        held: list[bytes] = []
        names: list = []
        lengths: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal seg, first
            ids = np.frombuffer(b"".join(held), "<u4")
            sizes, payload = pack(ids, block, plane_bits)
            row = {"shard": shard, "seg": seg, "first_id": first, "n_ids": len(ids), "doc_ids": list(names),
                   "lengths": list(lengths), "plane_bits": plane_bits, "block": block, "sizes": sizes, "payload": payload}
            seg, first = seg + 1, first + len(ids)
            held.clear(), names.clear(), lengths.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        size = 0
        for part, data, offs in text_slices(batches, 1, SLICE):
            raw, at = data.tobytes(), offs.tolist()
            for key, got in zip(part.column(0).to_pylist(), enc([raw[a:b] for a, b in zip(at, at[1:])])):
                names.append(key)
                lengths.append(len(got) // 4 + 1)
                held.extend((got, end))
                size += lengths[-1]
                if size >= segment:
                    yield close()
                    size = 0
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]      # rows with one id, or none, are dealt over partitions too
    ordered = rows.repartitionByRange(partitions_for(docs.sparkSession), *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):  # a batch is whole in both processes
        return stored(ordered.mapInArrow(encode, SEGMENT_SCHEMA), name)


def read_ids(segments: DataFrame) -> DataFrame:
    """One row per document, decoded from the segment files:
    shard, doc_id, local_start (ids before it in its shard), n_tokens, ids_crc32."""
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                ids = unpack(r["sizes"], r["payload"], r["n_ids"], r["block"], r["plane_bits"]).tobytes()
                ends = np.cumsum(r["lengths"])
                crc = [zlib.crc32(ids[4 * (e - n):4 * e]) for e, n in zip(ends, r["lengths"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * len(ends), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                     pa.array(r["first_id"] + ends - r["lengths"], pa.int64()), pa.array(r["lengths"], pa.int64()),
                     pa.array(crc, pa.int64())], schema=schema)

    return segments.mapInArrow(decode, INDEX_SCHEMA)


def shard_offsets(segments: DataFrame) -> DataFrame:
    """Ids in all shards before each shard.  One row per shard passes through the
    driver: as many as there are partitions, whatever the corpus."""
    totals = sorted(tuple(r) for r in segments.groupBy("shard").agg(F.sum("n_ids")).collect())
    before, rows = 0, []
    for shard, n in totals:
        rows.append((shard, before))
        before += n
    return segments.sparkSession.createDataFrame(rows, "shard int, shard_start long")


def token_index(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    return (read_ids(segments).join(F.broadcast(shard_offsets(segments)), "shard")
            .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(write_tokens(load(spark, sf_dir, "documents"), "tokens", tokenizer_path()))
