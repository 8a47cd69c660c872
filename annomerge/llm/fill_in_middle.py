"""Fill-in-middle by piece tables.

A document is a sequence of descriptors (buffer, start, end) over two immutable buffers, its text and the sentinels. Cuts
split descriptors, an arrangement permutes them, the inverse permutation over the descriptors of an output restores the
document, and hashes stream the descriptors; text is copied only where the output itself is asked for.

Defined cases: a null text counts as empty and stays plain, with no tokens; a null id hashes as empty text; rows with equal
ids are cut alike as far as their texts allow; a text that holds a sentinel stays plain; a part may be empty; input columns
named like a result give way to it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame

from annomerge.llm.common import map_texts, numbered, renamed

#: Sentinels before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Orders of the descriptors prefix, middle, suffix (0 to 2) and of the three sentinels (3 to 5).
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}


class PieceTable:
    """Descriptors over immutable buffers, in the order of what they spell."""

    def __init__(self, buffers: tuple[str, ...], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, place: int) -> None:
        """Split the first descriptor that reaches ``place``, counted along the sequence; a part may be empty."""
        at = 0
        for i, (buffer, start, end) in enumerate(self.pieces):
            if at + end - start >= place:
                middle = start + place - at
                self.pieces[i : i + 1] = [(buffer, start, middle), (buffer, middle, end)]
                return
            at += end - start
        raise ValueError("the cut lies behind the end")

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def stream(self) -> Iterator[str]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def text(self) -> str:
        return "".join(self.stream())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part.encode())
        return digest.hexdigest()


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(sorted(range(len(order)), key=order.__getitem__))


def token_ends(text: str):
    """Where tokens end: words with the white space before them, and white space at the end of the text."""
    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    return np.append(ends, len(codes)) if len(codes) and blank[-1] else ends


def transform(text: str, doc_id, seed: int, rate: int, spm: int) -> tuple[PieceTable, str, int]:
    """(table, form, number of tokens) of a document: ``rate`` of 100 are cut, ``spm`` of 100 of these with the suffix first."""
    h1, h2, h3, h4 = struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16])
    table, ends = PieceTable((text, "".join(SENTINELS)), [(0, 0, len(text))]), token_ends(text)
    if not text or h3 % 100 >= rate or any(s in text for s in SENTINELS):
        return table, "plain", len(ends)
    for units in sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1))):
        table.cut(int(ends[units - 1]) if units else 0)
    at = 0
    for s in SENTINELS:
        table.pieces.append((1, at, at + len(s)))
        at += len(s)
    form = "spm" if h4 % 100 < spm else "psm"
    return table.arranged(ORDERS[form]), form, len(ends)


def restore(output: str, form: str) -> PieceTable:
    """The document's table over an output: cut where the sentinels stand, in the form's order, and put back."""
    table = PieceTable((output,), [(0, 0, len(output))])
    if form == "plain":
        return table
    order, at = ORDERS[form], 0
    for i in order:
        if i >= 3:
            start = output.index(SENTINELS[i - 3], at)
            if start:
                table.cut(start)
            at = start + len(SENTINELS[i - 3])
            table.cut(at)
    back = table.arranged(inverse(order))
    return PieceTable(back.buffers, back.pieces[:3])


FIELDS = "fim_n long, fim_form string, fim_prefix_chars long, fim_middle_chars long, fim_output_sha256 string, fim_restored_sha256 string"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80, with_output: bool = True) -> DataFrame:
    """Adds ``fim_*``: tokens, form, code points of prefix and middle (null if plain), hashes of the output and of the document
    restored from it, and, if asked for, ``fim_output``, the text, and ``fim_pieces``, its descriptors. The text goes."""
    rows, key, text = numbered(docs.withColumn(text_col, docs[text_col].cast("string")), id_col, text_col)
    wanted = FIELDS + ", fim_output string, fim_pieces array<struct<buffer:int,start:long,end:long>>" * with_output

    def make():
        def each(texts: list, ids: list) -> dict[str, list]:
            out: dict[str, list] = {f.split()[0]: [] for f in FIELDS.split(", ")} | ({"fim_output": [], "fim_pieces": []} if with_output else {})
            for t, i in zip(texts, ids):
                table, form, n = transform(t or "", i, seed, rate, spm)
                output, order = table.text(), inverse(ORDERS[form]) if form != "plain" else None
                sizes = [table.pieces[order[k]][2] - table.pieces[order[k]][1] for k in (0, 1)] if order else [None, None]
                for name, value in zip(FIELDS.split(", "), (n, form, *sizes, table.sha256(), restore(output, form).sha256())):
                    out[name.split()[0]].append(value)
                if with_output:
                    out["fim_output"].append(output)
                    out["fim_pieces"].append([{"buffer": b, "start": s, "end": e} for b, s, e in table.pieces])
            return out

        return each

    new = [f.split()[0] for f in FIELDS.split(", ")] + ["fim_output", "fim_pieces"] * with_output
    return renamed(map_texts(rows, text, make, wanted, also=(key,)), docs.columns, *new)
