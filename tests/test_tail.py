"""The tail of growing line files: every line once, whatever was appended when (S-1)."""

import io
import random
import uuid

import pytest

from tidewatch.sources.decode import DECODERS
from tidewatch.sources.tail import lines_of, ranges, tail_lines
from tidewatch.streaming import wiring as Wr


@pytest.mark.parametrize("seed", range(5))
def test_ranges_cut_anywhere_give_every_line_once(seed):
    r = random.Random(seed)
    raw = b"".join(bytes(r.choice(b"ab ") for _ in range(r.randrange(0, 30))) + r.choice([b"\n", b"\n", b"\r\n"])
                   for _ in range(200)) + b"no line feed yet"
    cuts = sorted({0, len(raw), *(r.randrange(len(raw)) for _ in range(40))})
    got = [x for a, b in zip(cuts, cuts[1:]) for part in ranges({"f": a}, {"f": b}, r.choice([1, 7, 1000]))
           for x in lines_of(io.BytesIO(raw), part.start, part.end)]
    want, at = [], 0
    for line in raw.split(b"\n")[:-1]:
        want.append((at, line.removesuffix(b"\r").decode()))
        at += len(line) + 1
    assert got == want


def test_a_file_that_shrank_is_an_error():
    assert ranges({"f": 5}, {"f": 5, "g": 3}, 2)[0].file == "g"
    with pytest.raises(ValueError, match="shrank"):
        ranges({"f": 5}, {"f": 4}, 10)


def test_appended_lines_come_once_over_restarts(spark, tmp_path):
    folder, out, name = tmp_path / "logs", str(tmp_path / "out"), f"tail_{uuid.uuid4().hex[:8]}"
    folder.mkdir()
    steps = [{"a.log": "1,fail\n2,ok\n3,fa", "_skip.log": "no\n"}, {"a.log": "il\n4,ok\n", "b.log": "x\ny"}, {},
             {"b.log": "\nz\n", "c.txt": "other\n"}]
    written: dict[str, str] = {}
    for step in steps:                                     # a run per step: append, start, stop
        for file, more in step.items():
            written[file] = written.get(file, "") + more
            with open(folder / file, "a") as f:
                f.write(more)
        q = Wr.start(tail_lines(spark, str(folder), suffix=".log", max_bytes=4), name, sink="parquet", path=out, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None
        got = sorted((r.file.rsplit("/", 1)[1], r.position, r.value) for r in spark.read.parquet(out).collect())
        want = []
        for file in ("a.log", "b.log"):
            at = 0
            for line in written.get(file, "").split("\n")[:-1]:
                want.append((file, at, line))
                at += len(line) + 1
        assert got == sorted(want)


def test_tailed_lines_are_decoded(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "login.csv").write_text("5402,83.149.11.115,success,1558430815\n23064,66.249.3.15,fail,1558430826\n")
    q = Wr.start(DECODERS["login"](tail_lines(spark, str(tmp_path / "l")).select("value")), f"tl_{uuid.uuid4().hex[:6]}",
                 sink="parquet", path=str(tmp_path / "o"), available_now=True)
    q.awaitTermination(300)
    assert sorted((r.user_id, r.event_type) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == \
        [(5402, "success"), (23064, "fail")]
