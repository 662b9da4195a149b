"""Token ids in wavelet-matrix shards: one compressed file per shard, with access, rank, select and counting.

A shard holds whole documents in ascending doc_id order.  Its ids are kept as bit planes, most significant
bit first; each plane is stably partitioned by its bit before the next one, so that rank on the planes walks
any position or any token.  Files are written by tasks under a name that depends on the partition only.

Null text counts as empty (just the end id); a text with an added token's characters has that token's id, as the
library gives it.  Null doc_ids come first, rows of one doc_id are ordered by the hash of their text, and repeated
rows are each kept.  A text longer than a shard is a shard of its own.  An empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planmatch.llm.common import Numbers, documents, give_back, read, saved, scratch, text_key
from planmatch.llm.files import whole_file

MAGIC = b"WVMX1\0"
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
SHARD_TOKENS = 1 << 20
#: Pre-tokens that a worker remembers with their ids, and characters of text that it cuts into pieces at once.
CACHED_PIECES, SLICE_CHARS = 800_000, 4 << 20
STEP = 512  # bits between two entries of a plane's rank directory


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ------------------------------------------------------------------- the matrix


class WaveletMatrix:
    """Bit planes with a rank directory each; ``zeros[b]`` ids of plane b have bit 0 and lead in the next."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ranks = [np.concatenate([[0], np.cumsum(np.bitwise_count(p).reshape(-1, STEP // 8).sum(1, dtype=np.int64))]) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        width = width or max(1, int(ids.max(initial=0)).bit_length())
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros = [], []
        for b in range(width - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << b)) != 0
            bits = np.packbits(one)
            planes.append(np.concatenate([bits, np.zeros(-len(bits) % (STEP // 8), np.uint8)]))
            zeros.append(len(ids) - int(one.sum()))
            ids = np.concatenate([np.compress(~one, ids), np.compress(one, ids)])  # by positions: twice as fast as masks on mixed bits
        return cls(len(ids), planes, zeros)

    def _ones(self, b: int, i: int) -> int:
        """Ones among the first i bits of plane b."""
        k, at = divmod(i, STEP)
        part = self.planes[b][k * STEP // 8 : (k * STEP + at + 7) // 8]
        n = int(self.ranks[b][k]) + int(np.bitwise_count(part).sum())
        return n - (int(part[-1] & (0xFF >> at % 8)).bit_count() if at % 8 else 0)

    def _bit(self, b: int, i: int) -> int:
        return int(self.planes[b][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        v = 0
        for b in range(len(self.planes)):
            bit = self._bit(b, i)
            ones = self._ones(b, i)
            i = self.zeros[b] + ones if bit else i - ones
            v = v << 1 | bit
        return v

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for b in range(len(self.planes)):
            a, z = self._ones(b, lo), self._ones(b, hi)
            lo, hi = (self.zeros[b] + a, self.zeros[b] + z) if token >> (len(self.planes) - 1 - b) & 1 else (lo - a, hi - z)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions lo to hi (rank, where lo is 0)."""
        if token >> len(self.planes):
            return 0
        a, z = self._range(token, lo, self.n if hi is None else hi)
        return z - a

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0)."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for b in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - b) & 1
            want = i - self.zeros[b] if one else i
            lo, hi = 0, self.n  # the least prefix with over ``want`` such bits ends behind the position
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._ones(b, mid + 1)
                lo, hi = (lo, mid) if (ones if one else mid + 1 - ones) > want else (mid + 1, hi)
            i = lo
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for b in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[b], count=self.n).view(bool)
            up = np.empty_like(v)
            up[np.flatnonzero(~one)] = v[: self.zeros[b]]
            up[np.flatnonzero(one)] = v[self.zeros[b] :] | kind(1 << (len(self.planes) - 1 - b))
            v = up
        return v


def to_bytes(ids: np.ndarray, lengths: np.ndarray, doc_ids: list, part: int, seq: int) -> bytes:
    """File format: magic; part, seq, documents, ids, planes; then zstd sections, each after its length:
    doc_ids, their validity, lengths, and for each plane its zeros and bits."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    m = WaveletMatrix.build(ids)
    out = [MAGIC, struct.pack("<5q", part, seq, len(lengths), m.n, len(m.planes))]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    for raw in (np.array([d or 0 for d in doc_ids], "<i8"), known, lengths.astype("<i8"), np.array(m.zeros, "<i8"), *m.planes):
        z = squeeze(raw.tobytes())
        out += [struct.pack("<q", len(z)), z]
    return b"".join(out)


def from_bytes(raw: bytes) -> tuple[int, int, list, np.ndarray, WaveletMatrix]:
    """part, seq, doc_ids, lengths, matrix."""
    import zstandard

    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a wavelet shard")
    part, seq, docs, n, width = struct.unpack_from("<5q", raw, len(MAGIC))
    at, sections = len(MAGIC) + 40, []
    for _ in range(4 + width):
        (size,) = struct.unpack_from("<q", raw, at)
        sections.append(zstandard.ZstdDecompressor().decompress(raw[at + 8 : at + 8 + size]))
        at += 8 + size
    ids, known, lengths, zeros = (np.frombuffer(s, k) for s, k in zip(sections, ("<i8", np.uint8, "<i8", "<i8")))
    doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
    return part, seq, doc_ids, lengths, WaveletMatrix(n, [np.frombuffer(s, np.uint8) for s in sections[4:]], [int(z) for z in zeros])


# ------------------------------------------------------------------ tokenizing


class Rows:
    """Rows of ids of varying length, end to end."""

    def __init__(self):
        self.flat, self.size, self.start = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray, start: np.ndarray | None = None) -> None:
        """More rows: their ids, and where in these each begins (end to end if not said)."""
        start = np.cumsum(size) - size if start is None else start
        self.start, self.size = np.concatenate([self.start, start + len(self.flat)]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])

    def take(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows by number: their ids end to end, and their lengths."""
        size = self.size[of]
        first = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[of] - first, size) + np.arange(size.sum())], size


class Pieces:
    """Ids of whole texts through the tokenizers library, remembering the ids of pre-tokens that recur.

    A space between two characters that are not white space always begins a new pre-token of a byte-level
    tokenizer, so a text's ids are those of its pieces, cut there; each distinct piece of a slice of texts is
    looked at once.  Pieces of plain Latin text are cut further into pre-tokens by the tokenizer's own pattern,
    and the library's model encodes each new pre-token once; all other pieces, also those with what may be an
    added token, go through the whole library and are remembered as they are.
    """

    #: In front of the first piece of a text, which has no space before it; between pieces that are cut into pre-tokens.
    HEAD = "\0"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        # among plain characters these are all letters and all digits of the tokenizer's pattern
        letters, digits = "A-Za-zÀ-ÖØ-öø-ɏ", "0-9"
        pattern = public_tokenizers.PATTERN.replace(r"\s\p{L}\p{N}", rf"\s{letters}{digits}\0").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
        self.pretokens = re.compile(r"\0|" + pattern.replace(r"(?!\S)", r"(?![^\s\0])")).findall
        added = [re.escape(t.content) for t in self.lib.get_added_tokens_decoder().values()]
        self.hard = "|".join([r"[^\x00\n\t !-~À-ɏ]", r"[^\x00]\x00", r"\x00\x00", *added])
        white = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
        self.odd = rf"^ | $|[{white}] | [{white}]|\x00"
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        # byte-level models write bytes as printable characters: the printable ones as themselves, others from 256 up
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.signs = {chr(b): chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printable) if b}
        self.clear()

    def clear(self) -> None:
        self.number, self.rows = Numbers(), Rows()
        self.number.of([self.HEAD])  # number 0, without ids
        self.number.fresh()
        self.rows.add(np.zeros(0, "<u4"), np.zeros(1, np.int64))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def printable(self, words: list[str]) -> list[str]:
        """Pre-tokens as the model has them: a character for each byte."""
        joined = self.HEAD.join(words).encode().decode("latin1")
        for c in {*joined} & self.signs.keys():
            joined = joined.replace(c, self.signs[c])
        return joined.split(self.HEAD)

    def numbers(self, words: list[str], encode) -> np.ndarray:
        """Numbers of the rows of these; ``encode`` gives the ids of those not remembered."""
        of = self.number.of(words)
        new = self.number.fresh()
        if new:
            found = encode(new)
            size = np.fromiter(map(len, found), np.int64, len(found))
            self.rows.add(np.fromiter(chain.from_iterable(found), "<u4", int(size.sum())), size)
        return of

    def distinct(self, pieces) -> Rows:
        """Ids of distinct pieces (an Arrow array), each with a space in front but for the first of a text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        is_hard = pc.match_substring_regex(pieces, self.hard).to_numpy(zero_copy_only=False)
        easy, hard = pieces.filter(pa.array(~is_hard)), pieces.filter(pa.array(is_hard)).to_pylist()
        tokenize = self.model.tokenize
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(easy)], pa.int32()), easy), f"{self.HEAD} ")[0].as_py() if len(easy) else ""
        words = self.pretokens(f"{self.HEAD} {joined}".replace(f"{self.HEAD} {self.HEAD}", self.HEAD)) if len(easy) else []
        of = self.numbers(words, lambda new: [[t.id for t in tokenize(w)] for w in self.printable(new)])
        flat, each = self.rows.take(of)
        begins = np.flatnonzero(of == 0)
        if len(begins) != len(easy):
            raise ValueError("pieces and pre-tokens do not fit")
        start, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        start[~is_hard] = (np.cumsum(each) - each)[begins]
        size[~is_hard] = np.diff(start[~is_hard], append=len(flat))
        more, n = self.rows.take(self.numbers(hard, lambda new: self.whole([k[1:] if k[0] == self.HEAD else f" {k}" for k in new])))
        start[is_hard], size[is_hard] = len(flat) + np.cumsum(n) - n, n
        out = Rows()
        out.add(np.concatenate([flat, more]), size, start)
        return out

    def pieces(self, text: str) -> list[str]:
        """Of a text with a space beside white space, or with the sign for the first piece."""
        if self.HEAD in text:
            return [self.HEAD + text]
        first, *more = self.cut(text)
        return [self.HEAD + first, *more]

    def encode(self, texts) -> list[bytes]:
        """Little-endian 32-bit ids of each text (a list, or an Arrow array); a slice of the texts at a time, so that few pieces are held beside the remembered ones."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        out, at = [], 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_CHARS, "right")))
            out += self._encode(texts.slice(at, end - at))
            at = end
            if len(self.number) > CACHED_PIECES:
                self.clear()
        return out

    def _encode(self, texts) -> list[bytes]:
        import pyarrow as pa
        import pyarrow.compute as pc

        is_odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.binary_join_element_wise(self.HEAD, texts.filter(pa.array(~is_odd)), ""), " ")
        odd = [self.pieces(t) for t in texts.filter(pa.array(is_odd)).to_pylist()]
        pieces = pa.concat_arrays([cut.flatten(), pa.array([p for c in odd for p in c], pa.string())]).dictionary_encode()
        flat, size = self.distinct(pieces.dictionary).take(pieces.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *cut.value_lengths().to_numpy(zero_copy_only=False), *map(len, odd)])].tolist()
        raw, out = flat.tobytes(), [b""] * len(texts)
        for i, a, z in zip(np.argsort(is_odd, kind="stable").tolist(), ends, ends[1:]):
            out[i] = raw[4 * a : 4 * z]
        return out


_pieces: dict[str, Pieces] = {}


def encoder(path: str) -> Pieces:
    """One for each worker, kept between tasks."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


# -------------------------------------------------------------------- the jobs


def write_shards(docs: DataFrame, folder: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Writes ``folder/*.wvm``; lazily returns a manifest (path, part, seq, n_docs, n_tokens)."""
    order = [F.col("doc_id").asc_nulls_first(), "th", "tie"]
    ordered = (documents(docs).withColumn("th", text_key()).withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))

    def write(batches):
        import pyarrow as pa

        lib, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, raws, total = [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            lengths = np.array([len(r) // 4 for r in raws], np.int64)
            ids = np.frombuffer(b"".join(raws), "<u4")
            path = f"{folder}/{part:06d}-{seq:06d}.wvm"
            with whole_file(path) as out:
                out.write(to_bytes(ids, lengths, doc_ids, part, seq))
            row = {"path": [path], "part": [part], "seq": [seq], "n_docs": [len(raws)], "n_tokens": [len(ids)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("path", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), lib.encode(batch.column(1))):
                doc_ids.append(doc)
                raws.append(raw + end)
                total += len(raw) // 4 + 1
                if total >= shard_tokens:
                    yield flush()
                    doc_ids, raws, total, seq = [], [], 0, seq + 1
        if raws:
            yield flush()
        raws.clear()
        give_back()

    return ordered.mapInArrow(write, "path string, part long, seq long, n_docs long, n_tokens long")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: part, seq, doc_id, at (first id in its shard), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("content")

    def rows(batches):
        import pyarrow as pa

        schema = pa.schema([(k, pa.int64()) for k in ("part", "seq", "doc_id", "at", "n_tokens", "ids_crc32")])
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                part, seq, doc_ids, lengths, matrix = from_bytes(raw)
                ids = matrix.ids().astype("<u4").tobytes()
                at = np.cumsum(lengths) - lengths
                crc = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict({"part": [part] * len(crc), "seq": [seq] * len(crc), "doc_id": doc_ids, "at": at, "n_tokens": lengths, "ids_crc32": crc}, schema)
        give_back()

    return files.mapInArrow(rows, "part long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids before the document, over all shards in order (sums within parts, then over parts)."""
    shards = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    shards = shards.select("part", "seq", F.coalesce(F.sum("n").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("inner"))
    return rows.join(shards.join(parts, "part"), ["part", "seq"]).withColumn("start", F.col("base") + F.col("inner") + F.col("at"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op1: written to shards, read back from them."""
    folder = scratch(spark, "wavelet")
    manifest = write_shards(read(spark, sf_dir, "documents"), folder, tokenizer_path())
    manifest.write.parquet(f"{folder}/manifest")
    if not spark.read.parquet(f"{folder}/manifest").head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return with_starts(saved(read_shards(spark, folder), "shard-rows")).select("doc_id", "start", "n_tokens", "ids_crc32")
