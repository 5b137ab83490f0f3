"""Archives by member: seeks, pieces, nested archives as streams."""

from __future__ import annotations

import io
import random
import tracemalloc
import zipfile

import pytest

from tripforge.sources import archives


def packed(members, method=zipfile.ZIP_DEFLATED, seekable=True) -> bytes:
    out = io.BytesIO()
    if not seekable:  # lengths and checksum behind each member
        out.seek = out.tell = None
        out.seekable = lambda: False
        target = type("Sink", (), {"write": lambda self, b: out.write(b), "flush": lambda self: None})()
    with zipfile.ZipFile(out if seekable else target, "w", method) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return out.getvalue()


def stream(data: bytes, step: int):
    return iter([data[k : k + step] for k in range(0, len(data), step)])


@pytest.mark.parametrize("step", [1, 7, 1000])
@pytest.mark.parametrize("method, seekable", [(zipfile.ZIP_DEFLATED, True), (zipfile.ZIP_DEFLATED, False), (zipfile.ZIP_STORED, True)])
def test_zips_from_front_to_back(step, method, seekable):
    rng = random.Random(3)
    members = {"a.csv": "", "é/b.txt": "x" * 5000, "c.csv": "".join(rng.choice("PK\x03\x04\n") for _ in range(900)), "d": "last"}
    data = packed(members, method, seekable)
    got = {name: b"".join(pieces).decode() for name, pieces in archives.front_to_back(stream(data, step))}
    assert got == members
    assert [name for name, _ in archives.front_to_back(stream(data, step))] == list(members)
    with pytest.raises(zipfile.BadZipFile):
        list(archives.front_to_back(stream(b"no zip", step)))
    with pytest.raises(zipfile.BadZipFile):
        for _, pieces in archives.front_to_back(stream(data[:120], step)):
            list(pieces)


@pytest.mark.parametrize("step", [1, 2, 5, 1000])
def test_lines_of_pieces(step):
    text = "é1\r\n2\r3\n\n\r\r\n x\x0b\x0c4"
    assert list(archives.text_lines(stream(text.encode(), step))) == [x.rstrip("\n") for x in io.StringIO(text, newline=None)]
    assert list(archives.text_lines(stream(text.encode() + b"\r", step)))[-1] == " x\x0b\x0c4"
    assert list(archives.text_lines(iter([b"a\xff\n\xc3"]))) == ["a�", "�"]


def test_large_members_in_little_memory(tmp_path):
    line = b"0123456789" * 10 + b"\n"
    inner = packed({"deep.csv": line * 1_000_000})
    (tmp_path / "a.zip").write_bytes(packed({"x.csv": line * 1_000_000, "in.zip": inner}))
    tracemalloc.start()
    with archives._open(str(tmp_path / "a.zip")) as f, zipfile.ZipFile(f) as z:
        sizes = {}
        for batch in archives._read("a", z, ["x.csv", "in.zip"], (".csv",)):
            sizes[batch.column(1)[0].as_py()] = sizes.get(batch.column(1)[0].as_py(), 0) + batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == {"x.csv": 1_000_000, "in.zip!deep.csv": 1_000_000}
    assert peak < 60 << 20


def test_members_of_archives_go_to_tasks_apart(spark, tmp_path):
    want = set()
    for k in range(3):
        members = {f"m{i}.csv": f"{k},{i}\nx" for i in range(20)} | {"other.bin": "z", "j.json": "{}"}
        members["n.zip"] = packed({"p/q.txt": f"deep{k}", "deeper.zip": packed({"r.csv": "r"})})
        (tmp_path / f"{k} a.zip").write_bytes(packed(members))
        want |= {(f"{k} a.zip", f"m{i}.csv", n, line) for i in range(20) for n, line in ((1, f"{k},{i}"), (2, "x"))} | {(f"{k} a.zip", "n.zip!p/q.txt", 1, f"deep{k}"), (f"{k} a.zip", "n.zip!deeper.zip!r.csv", 1, "r")}
    data = (tmp_path / "0 a.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(data[: len(data) // 2])
    got = archives.read_archives(spark, str(tmp_path))
    found = {(r.archive.rsplit("/", 1)[-1].replace("%20", " "), r.member, r.line_no, r.line) for r in got.collect()}
    assert found == want | {("cut.zip", None, None, None)}
    with_json = {r.member for r in archives.read_archives(spark, str(tmp_path / "1 a.zip"), keep_json=True).collect()}
    assert "j.json" in with_json
    members = archives.list_members(spark.createDataFrame([(str(tmp_path / "1 a.zip"),)], "path string"))
    assert members.count() == 23
