"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokens: a batch of texts is cut into parts (runs of letters, of signs, single digits) by array operations; distinct
parts are looked up in a bounded cache, and what it lacks goes through the tokenizer, many parts in one call. Packing:
bounded-space online best fit. A task keeps a fixed number of open bins, held by free space with a bitset of the free
spaces in use, puts each piece where the least space stays, and closes the fullest bin when it needs another.

Defined cases: a null or empty text is one piece holding the end id alone; a null id is kept; repeated rows are
packed once each; an empty table gives no rows; a text of more than ``max_len`` ids is cut and nothing is dropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import materialise, slices

#: Bytes by what the tokenizer does with them: white space ends words; runs of letters and of signs are parts of their own; each
#: digit is one. A word with any other byte (apostrophes, control characters, letters beyond Latin-1) stays whole.
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
#: Lower-cased parts that many can be encoded of in one call.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def byte_kinds():
    import numpy as np

    kinds = np.full(256, OTHER, np.uint8)
    kinds[list(b" \t\n\r\x0b\x0c")] = SPACE
    kinds[list(b"0123456789")] = DIGIT
    kinds[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = SIGN
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = LETTER
    return kinds


class TokenBytes:
    """Ids of texts as little-endian 32-bit bytes, the same as the tokenizer's own.

    White space separates words for this tokenizer, and a plain word's letters, digits and signs are separate parts, so a
    text's ids are its parts' ids one after another. Parts are told apart for a whole batch at once; only distinct ones are
    looked up, and those not known go through the tokenizer, many in one call. Known parts are kept in two generations of
    at most ``most`` each; when the newer is full the older is forgotten.
    """

    def __init__(self, path: str, most: int = 400_000):
        import numpy as np
        from tokenizers import Tokenizer

        self.np, self.most = np, most
        self.tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends, self.kinds = ends, byte_kinds()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        return self.np.asarray(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, parts: list[bytes]) -> None:
        """A plain part is one word of the tokenizer, so its last token, and no other, ends a word."""
        np = self.np
        plain = [p for p in parts if PLAIN.fullmatch(p)]
        ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(plain):
            data, stops = ids.tobytes(), (4 * stops).tolist()
            self.known.update(zip(plain, (data[a:b] for a, b in zip([0, *stops], stops))))
        for p in parts:
            if p not in self.known:
                self.known[p] = self.encode(p)

    def look_up(self, parts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        new = [p for p in parts if p not in self.known]
        self.known.update((p, self.older[p]) for p in new if p in self.older)
        if missing := [p for p in new if p not in self.older]:
            self.learn(missing)
        return [self.known[p] for p in parts]

    def parts(self, joined: bytes):
        """Places where parts begin, and the parts as an Arrow array, lower-cased but for words that stay whole."""
        np = self.np
        data = np.frombuffer(joined, np.uint8)
        kind = self.kinds[data]
        after = np.flatnonzero(data == 0xC3) + 1
        after = after[after < len(data)]
        no_letter = (data[after] == 0x97) | (data[after] == 0xB7)
        other = [np.flatnonzero(kind == OTHER), after[no_letter]]
        if b"<|" in joined:  # special tokens, which case and neighbours matter to
            other.append(np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)))
        other = np.concatenate(other)
        space = kind == SPACE
        if len(other):
            ends = np.concatenate(([-1], np.flatnonzero(space), [len(data)]))
            word = np.unique(np.searchsorted(ends, other))
            first, size = ends[word - 1] + 1, ends[word] - ends[word - 1] - 1
            kind[np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))] = OTHER
        low = data | ((data >= 0x41) & (data <= 0x5A) & (kind == LETTER)).astype(np.uint8) << 5
        upper = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (kind[after] == LETTER)]
        low[upper] += 0x20
        begin = kind == DIGIT
        begin[1:] |= kind[1:] != kind[:-1]
        begin[:1] = True
        begin &= ~space
        begins = np.flatnonzero(begin)
        packed = low[~space]
        offsets = np.append(begins - np.cumsum(space, dtype=np.int64)[begins], len(packed))
        return begins, pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])

    def __call__(self, texts: list[bytes]) -> list[memoryview]:
        """The ids' bytes of each text."""
        np = self.np
        begins, parts = self.parts(b" ".join(texts))
        if not len(begins):
            return [memoryview(b"")] * len(texts)
        coded = parts.dictionary_encode()
        taken = pa.array(self.look_up(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        _, offsets, data = taken.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(taken) + 1]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = offsets[np.searchsorted(begins, starts)].tolist()
        view = memoryview(data)
        return [view[a:b] for a, b in zip(at, at[1:])]


def chunks(text: bytes, most: int = 8 << 20) -> Iterator[bytes]:
    """The text cut at blanks into parts of at most ``most`` bytes, more only where no blank stands in between."""
    while len(text) > most:
        at = text.rfind(b" ", 0, most)
        at = text.find(b" ", most) if at <= 0 else at
        if at < 0:
            break
        yield text[:at]
        text = text[at:]
    yield text


TOKENISERS: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    """One per Python worker, which Spark keeps between tasks."""
    if path not in TOKENISERS:
        TOKENISERS[path] = TokenBytes(path)
    return TOKENISERS[path]


def tokenise_pieces(docs: DataFrame, tokenizer: str, max_len: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (array<long>) of each piece."""
    import numpy as np

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = token_bytes(tokenizer), int(end_id).to_bytes(4, "little")
        for whole in batches:
            for batch in slices(whole, 1):
                out: list[tuple] = []
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                for doc, coded in zip(batch.column(0).to_pylist(), encode(texts) if len(texts) > 1 else [b"".join(x for c in chunks(texts[0]) for x in encode([c]))]):
                    data = bytes(coded) + end
                    for piece, at in enumerate(range(0, len(data), 4 * max_len)):
                        cut = data[at : at + 4 * max_len]
                        out.append((doc, piece, at // 4, len(cut) // 4, zlib.crc32(cut)) + ((np.frombuffer(cut, "<u4").tolist(),) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


class OpenBins:
    """Open bins by free space. ``spaces`` has bit f set while a bin with f free places is open."""

    def __init__(self, max_len: int, most: int):
        self.max_len, self.most, self.open = max_len, most, 0
        self.spaces = 0
        self.bins: dict[int, list[int]] = {}
        self.made = 0

    def take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            del self.bins[free]
            self.spaces ^= 1 << free
        self.open -= 1
        return number

    def keep(self, number: int, free: int) -> None:
        if free:
            self.bins.setdefault(free, []).append(number)
            self.spaces |= 1 << free
            self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset): the open bin that this piece fills best, else a new one."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self.take(free)
        else:
            free, number = self.max_len, self.made
            self.made += 1
            if self.open >= self.most and length < self.max_len:
                self.take((self.spaces & -self.spaces).bit_length() - 1)
        self.keep(number, free - length)
        return number, self.max_len - free


def pack(pieces: DataFrame, max_len: int = 4096, open_bins: int = 512, rows_per_task: int = 250_000) -> DataFrame:
    """Adds sequence_id and offset. Tasks pack independently; their number follows the number of pieces, so each
    has enough of them to fill its bins and the bins left open at the end are a small share."""
    tasks = max(1, -(-pieces.count() // rows_per_task))
    kept = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(max_len, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return pieces.repartition(tasks).mapInArrow(run, schema).select(*kept, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = 4096, end_id: int = 1, open_bins: int = 512, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack. The pieces are written once, without texts, so that packing moves small rows only."""
    pieces = tokenise_pieces(docs, tokenizer, max_len, end_id, id_col, text_col, with_ids)
    return pack(materialise(pieces, "pieces"), max_len, open_bins)
