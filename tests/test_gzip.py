"""Lines of gzip files of many members, at several split sizes."""

import gzip
import random
import re
import zlib
from pathlib import Path

import pytest

from tessera.session import checkpoint_dir
from tessera.sources.gzip_lines import MAGIC, read_gzip_lines


@pytest.mark.parametrize("split_bytes", [150, 4000, 1 << 26])
def test_lines_equal_the_file(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    want = []
    for f, ends in enumerate((True, False, True)):
        lines = [f"{f}:{i} " + "".join(rng.choices("abcdefgh ", k=rng.randrange(60))) for i in range(400)] + ["", "é ü", "last"]
        text = ("\r\n" if f == 2 else "\n").join(lines).encode() + (b"\n" if ends else b"")
        cuts = sorted({0, len(text), *(rng.randrange(len(text)) for _ in range(60))})
        if f == 1:  # a stored member whose text looks like a member
            text = MAGIC + b"\x00 not a member\n" + text
            lines = [(MAGIC + b"\x00 not a member").decode("latin1"), *lines]
            cuts = sorted({0, len(text), *(rng.randrange(40, len(text)) for _ in range(30))})
        level = 0 if f == 1 else 6
        (tmp_path / f"{f}.gz").write_bytes(b"".join(gzip.compress(text[a:z], level) for a, z in zip(cuts, cuts[1:], strict=False)))
        want += lines
    (tmp_path / "empty.gz").write_bytes(gzip.compress(b""))
    got = read_gzip_lines(spark, str(tmp_path), split_bytes)
    fix = lambda x: x.encode("latin1").decode("utf-8", "replace") if "not a member" in x else x
    assert sorted(r.value for r in got.collect()) == sorted(map(fix, want))


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "log.gz"
    path.write_bytes(b"".join(gzip.compress(f"line {i}\n".encode() * 50) for i in range(200)))
    size = path.stat().st_size
    got = read_gzip_lines(spark, str(path), size // 6)
    plan_rows = got.groupBy("value").count().collect()
    assert len(plan_rows) == 200 and {r["count"] for r in plan_rows} == {50}
    cut = spark.read.format("binaryFile").load(str(path)).select("length").first()[0]
    assert cut == size


def test_ranges_are_dealt_to_tasks(spark, tmp_path):
    for f in range(4):
        (tmp_path / f"{f}.gz").write_bytes(gzip.compress(b"".join(b"line %d\n" % (f * 1000 + i) for i in range(1000))))
    shared = Path(re.sub("^file:/*", "/", checkpoint_dir(spark)))
    before = set(shared.glob("gzip-lines-*"))
    got = read_gzip_lines(spark, str(tmp_path), 1000)
    assert sorted(r.value for r in got.collect()) == sorted(f"line {i}" for i in range(4000))
    (cut,) = set(shared.glob("gzip-lines-*")) - before
    assert len(list(cut.glob("part-*"))) > 2  # one task read all ranges before


def test_a_damaged_file_is_an_error(spark, tmp_path):
    whole = gzip.compress(b"some text\n" * 100)
    (tmp_path / "cut.gz").write_bytes(whole[:-9])
    with pytest.raises(Exception, match="cut off|invalid|incorrect"):
        read_gzip_lines(spark, str(tmp_path / "cut.gz")).collect()
    assert zlib.decompress(whole, 31).count(b"\n") == 100
