"""Block-gzip files in byte ranges: the same lines, in the same order, wherever the file is cut."""

import gzip
import random
import zlib

import pytest
from pyspark.sql import functions as F

from annomerge.plans import jobs
from annomerge.sources import blocks, readers


def bgzf(path, data: bytes, rng, longest=300):
    """Blocks of uneven sizes, empty ones among them."""
    with open(path, "wb") as f:
        at = 0
        while at < len(data):
            piece = data[at : at + rng.choice([0, 1, 7, longest])]
            squeeze = zlib.compressobj(rng.choice([0, 9]), zlib.DEFLATED, -15)
            body = squeeze.compress(piece) + squeeze.flush()
            f.write(blocks.END[:16] + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(piece).to_bytes(4, "little") + len(piece).to_bytes(4, "little"))
            at += len(piece)
        f.write(blocks.END)


def in_ranges(path, step):
    size = path.stat().st_size
    out = []
    with open(path, "rb") as f:
        for start in range(0, size, step):
            out += blocks.Blocks(f, size).lines(start, min(size, start + step))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_lines_do_not_depend_on_the_cut(tmp_path, seed):
    rng = random.Random(seed)
    # header magic inside stored data, long lines over many blocks, empty lines, no line feed at the end
    words = [b"a", b"", b"bc\td", blocks.END, blocks.MAGIC + b"\0" * 6 + b"\x06\0BC\x02\0\x40\0", b"x" * 2000, b"tab\t"]
    data = b"\n".join(rng.choice(words) for _ in range(200)) + rng.choice([b"", b"\n"])
    bgzf(tmp_path / "x.gz", data, rng)
    want = data.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    whole = in_ranges(tmp_path / "x.gz", 1 << 30)
    assert [line for _, line in whole] == want and gzip.open(tmp_path / "x.gz").read() == data
    assert [at for at, _ in whole] == sorted({at for at, _ in whole})
    for step in (1, 13, 100, 1001, 20_000):
        assert in_ranges(tmp_path / "x.gz", step) == whole


def test_broken_blocks_raise(tmp_path):
    bgzf(tmp_path / "x.gz", b"abc\n" * 500, random.Random(1))
    data = bytearray((tmp_path / "x.gz").read_bytes())
    data[60] ^= 255
    (tmp_path / "x.gz").write_bytes(data)
    for step in (1 << 30, 500, 60, 17):
        with pytest.raises((ValueError, zlib.error)):
            in_ranges(tmp_path / "x.gz", step)


def am_file(path, rng):
    text = "# notes\n" * 40 + "uniprot_id\tprotein_variant\tam_pathogenicity\tam_class\n"
    text += "".join(f"P{rng.randrange(9)}\tM{rng.randrange(1, 400)}A\t0.{rng.randrange(1000)}\t{rng.choice(['x', ''])}\n" for _ in range(4000)) + "P1\tM1A\n\n\t\nP1\tA1\t\"q\t\n"
    bgzf(path, text.encode(), rng, 5000)


def test_split_files_equal_one_task(spark, tmp_path):
    am_file(tmp_path / "am.tsv.gz", random.Random(5))
    path = str(tmp_path / "am.tsv.gz")
    one = [tuple(r)[:4] for r in readers.read_alphamissense(spark, path, order=True).orderBy("ord").collect()]
    for split in (900, 7_000, 1 << 30):
        rows = readers.read_alphamissense(spark, path, order=True, split_bytes=split)
        assert (rows.rdd.getNumPartitions() > 1) == (split < 1 << 20)
        assert [tuple(r)[:4] for r in rows.orderBy("ord").collect()] == one
    last = [jobs.parse_alphamissense(readers.read_alphamissense(spark, path, order=True, split_bytes=s)).groupBy("uniprot_id", "hgvs_p").agg(F.max_by("alphamissense_score", "ord")).orderBy("uniprot_id", "hgvs_p").collect() for s in (900, 1 << 30)]
    assert last[0] == last[1] and len(last[0]) > 1000


def test_plain_gzip_is_one_range(spark, tmp_path):
    with gzip.open(tmp_path / "am.tsv.gz", "wt") as f:
        f.write("# n\nuniprot_id\tprotein_variant\tam_pathogenicity\tam_class\nP1\tM1A\t0.5\tx\r\nP1\tM2A\n")
    with gzip.open(tmp_path / "am.tsv.gz", "at") as f:  # a second member
        f.write("P2\tM3A\t0.1\ty")
    rows = readers.read_alphamissense(spark, str(tmp_path), order=True, split_bytes=10)
    assert rows.rdd.getNumPartitions() == 1
    assert [tuple(r)[:4] for r in rows.orderBy("ord").collect()] == [("P1", "M1A", "0.5", "x"), ("P1", "M2A", None, None), ("P2", "M3A", "0.1", "y")]


def test_summary_and_bulk_scores(spark, tmp_path):
    rng = random.Random(2)
    head = "#" + "\t".join(f"h{i}" for i in range(34)) + "\n"
    bgzf(tmp_path / "s.gz", (head + "".join("\t".join(f'{k}."{i}' for i in range(34)) + "\n" for k in range(50))).encode(), rng)
    want = [tuple(r) for r in readers.read_clinvar(spark, str(tmp_path / "s.gz")).collect()]
    got = readers.read_clinvar(spark, str(tmp_path / "s.gz"), order=True, split_bytes=400).orderBy("ord").drop("ord").collect()
    assert [tuple(r) for r in got] == want and len(want) == 50
    bgzf(tmp_path / "c.gz", ("## v\n#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED\n" + "".join(f"1\t{k}\tA\tC\t0.5\t7\n" for k in range(300))).encode(), rng)
    got = readers.read_cadd(spark, str(tmp_path / "c.gz"), order=True, split_bytes=200).orderBy("ord").collect()
    assert [tuple(r)[:6] for r in got] == [("1", k, "A", "C", 0.5, 7.0) for k in range(300)]


def test_written_blocks(spark, tmp_path):
    lines = spark.range(30_000, numPartitions=3).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    assert sum(r.n_lines for r in blocks.write_blocks(lines, str(tmp_path / "out"), head=("# top",)).collect()) == 30_000
    got = blocks.read_lines(spark, str(tmp_path / "out"), 20_000, comment="#")
    assert got.rdd.getNumPartitions() > 3
    assert [r.line for r in got.orderBy("file", "at").collect()] == [f"line {k}" for k in range(30_000)]
    assert blocks.read_lines(spark, str(tmp_path / "out"), 20_000).count() == 30_003


def test_many_small_ranges_are_widened(tmp_path):
    assert blocks.range_bytes(10_000, 900) == 900 and blocks.range_bytes(256 << 20, 32 << 10) == 1 << 20
    assert blocks.range_bytes(1 << 40, 32 << 10) == 64 << 20 and blocks.range_bytes(1 << 40, 1 << 30) == 1 << 30
    for k in range(3):
        bgzf(tmp_path / f"{k}.gz", b"".join(b"%d\n" % i for i in range(20_000)), random.Random(k))
    reader = blocks.LineReader({"path": str(tmp_path), "split_bytes": "50"})
    ranges = reader.partitions()
    assert 200 < len(ranges) <= 256 + 3
    lines = [line for r in ranges for batch in reader.read(r) for line in batch["line"].to_pylist()]
    assert lines == 3 * [str(i) for i in range(20_000)]
