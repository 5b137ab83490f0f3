"""WARC, chat formatting and URL filters: round trips and brute force."""

from __future__ import annotations

import gzip
import hashlib
import zlib
import json
import time

import pytest
from pyspark.sql import functions as F

from tripforge.llm import chat_format as cf
from tripforge.llm import queries, warc
from tripforge.llm.url_filters import filter_urls, host_of, validity_intervals

PAGES = "page_id long, url string, html string, payload string"


def read_back(spark, tmp_path, rows):
    warc.write_warc(warc.page_records(spark.createDataFrame(rows, PAGES)), str(tmp_path / "w"))
    return warc.read_pages(spark, str(tmp_path / "w")).collect()


def test_warc_round_trip_with_odd_pages(spark, tmp_path):
    long = "é" * 200_000
    same = "s" * 100
    rows = [(5, "http://a/\r\nWARC-Type: fake", same, "c"), (3, "http://b", same, "c"), (9, None, same, "c"), (1, "u", "x" * 99, "c"), (2, "u", "x" * 99, "c"), (4, "u", None, "c"), (6, "u", "", "c"), (7, "u", long, "c"), (8, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", "c"), (None, "u", same, "c"), (8, "u", "twice", "c"), (8, "u", "twice", "c")]
    got = read_back(spark, tmp_path, rows)
    assert len(got) == len(rows)
    want = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        first = 3 if h == same else None
        again = first is not None and i != first
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_warc_empty_table(spark, tmp_path):
    assert read_back(spark, tmp_path, []) == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_filters_and_skipped_payloads(spark, tmp_path, compression):
    path = str(tmp_path / "w")
    df = spark.createDataFrame([("response", f"<urn:x:{k}>", f"http://h{k % 3}/", bytearray(b"p" * k * 100), "extra") for k in range(50)] + [("metadata", "<urn:m>", None, bytearray(b"m"), "extra")], "record_type string, record_id string, target_uri string, payload binary, other string")
    warc.write_warc(df, path, compression=compression, maxFileBytes="5000")
    all_of = warc.read_warc(spark, path)
    assert all_of.count() == 51 and all_of.select("file").distinct().count() > 1
    assert all_of.where("record_type = 'metadata'").select("payload").first().payload == b"m"
    assert all_of.where("target_uri = 'http://h1/'").count() == 17 and all_of.where("record_type in ('metadata', 'x')").count() == 1
    assert warc.read_warc(spark, path, recordTypes="metadata", payload="false").select("payload").collect()[0].payload is None
    assert all_of.where("record_id = '<urn:x:7>'").select(F.length("payload")).first()[0] == 700


def test_warc_pushes_filters_to_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan

    r = warc.WarcReader({"path": "x"})
    left = list(r.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5)]))
    assert r.tests == [("warc-type", "in", ("response",))] and len(left) == 1


def test_warc_of_others(spark, tmp_path):
    """Plain gzip members without the length field."""
    one = warc.record_bytes({"record_type": "resource", "record_id": "<a>", "payload": b"hello", "content_type": "text/plain"})
    two = warc.record_bytes({"record_type": "response", "record_id": "<b>", "payload": b"y" * 10_000})
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    got = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert got == {"<a>": b"hello", "<b>": b"y" * 10_000}
    (tmp_path / "y.warc").write_bytes(b"rubbish\r\n\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_warc_records_in_any_members(spark, tmp_path, monkeypatch):
    """Several records in a gzip member, records across members, a file of one member, blank lines between records, padding."""
    rows = [{"record_type": "metadata" if k % 3 else "response", "record_id": f"<{k}>", "target_uri": "http://t/" if k % 2 else None, "payload": bytes([65 + k]) * (k * 700), "content_type": "text/plain"} for k in range(12)]
    raw = [warc.record_bytes(r) for r in rows]
    whole = b"".join(raw)
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "pairs.warc.gz").write_bytes(b"".join(gzip.compress(raw[k] + raw[k + 1]) for k in range(0, 12, 2)) + bytes(40))
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(gzip.compress(whole[k : k + 1111]) for k in range(0, len(whole), 1111)))
    (tmp_path / "plain.warc").write_bytes(b"\r\n".join(raw))
    want = sorted((r["record_id"], bytes(r["payload"])) for r in rows)
    for piece in (warc.PIECE, 100):
        monkeypatch.setattr(warc, "PIECE", piece)
        for name in ("one.warc.gz", "pairs.warc.gz", "cut.warc.gz", "plain.warc"):
            f = warc.fs.LocalFileSystem().open_input_file(str(tmp_path / name))
            assert sorted((h["warc-record-id"], p) for _, h, p in warc.records(f, [], True)) == want
            kept = list(warc.records(f, [("warc-type", "in", ("response",))], False))
            assert [h["warc-record-id"] for _, h, _ in kept] == ["<0>", "<3>", "<6>", "<9>"] and all(p is None for *_, p in kept)
    monkeypatch.undo()
    df = warc.read_warc(spark, str(tmp_path))
    assert df.count() == 48 and df.where("target_uri is not null").count() == 24 and df.where("target_uri is null").count() == 24


def test_warc_bodies_without_their_encodings(spark, tmp_path):
    text = b"<html>" + b"abc" * 300
    chunks = b"".join(b"%x;x=1\r\n%s\r\n" % (len(c), c) for c in (text[:100], text[100:])) + b"0\r\n\r\n"
    packed = gzip.compress(text)
    cases = [
        (b"Transfer-Encoding: chunked", chunks, text),
        (b"Transfer-Encoding: chunked", text, text),
        (b"Content-Encoding: gzip", packed, text),
        (b"Content-Encoding: deflate\r\nTransfer-Encoding:\r\n chunked", b"%x\r\n%s\r\n0\r\n\r\n" % (len(zlib.compress(text)), zlib.compress(text)), text),
        (b"Content-Encoding: gzip", text, text),
        (b"Content-Encoding: br", text, text),
        (b"X: y", chunks, chunks),
    ]
    with open(tmp_path / "a.warc", "wb") as f:
        for i, (field, body, _) in enumerate(cases):
            block = b"HTTP/1.1 200 OK\r\n" + field + b"\r\n\r\n" + body
            f.write(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:%d>\r\nWARC-Target-URI: <http://h/%d\r\n x>\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, i, len(block), block))
    got = {r.record_id: (bytes(r.payload), r.target_uri) for r in spark.read.format("warc").load(str(tmp_path / "a.warc")).collect()}
    assert got == {f"<urn:{i}>": (want, f"http://h/{i} x") for i, (*_, want) in enumerate(cases)}


def test_warc_missing_path_and_cut_file(spark, tmp_path):
    with pytest.raises(Exception, match="no WARC archives"):
        warc.read_warc(spark, str(tmp_path / "nowhere")).collect()
    assert warc.read_warc(spark, str(tmp_path)).collect() == []
    one = warc.record_bytes({"record_id": "<a>", "payload": b"x" * 5_000})
    for name, data in (("a.warc.gz", gzip.compress(one)[:-20]), ("b.warc.gz", gzip.compress(one[:-100])), ("c.warc", one[:-100])):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="cut off"):
            warc.read_warc(spark, str(tmp_path / name)).collect()


def test_warc_null_headers(spark, tmp_path):
    (tmp_path / "n.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n" + warc.record_bytes({"record_id": "<a>", "payload": b"hello"}))
    df = warc.read_warc(spark, str(tmp_path))
    assert df.count() == 2 and df.where("record_type is not null").count() == 1 and df.where("record_id is null").count() == 1


# ---- chat formatting ------------------------------------------------------------------------------------------------


def test_chat_layouts_meet_in_canonical_turns(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}),
        (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}),
        (3, {"prompt": "q", "response": "a"}),
        (4, {"instruction": "q", "output": "a"}),
        (5, {"instruction": "s", "input": "q", "output": "a"}),
        (6, {"messages": []}),
        (7, {"other": 1}),
    ]
    df = spark.createDataFrame([(i, json.dumps(r), "clash") for i, r in records] + [(8, "no json", "x"), (9, None, "x")], "conv_id long, raw string, layout string")
    got = {r.conv_id: r for r in cf.canonical_turns(df).collect()}
    turns = {i: None if r.turns is None else [(t.role, t.text) for t in r.turns] for i, r in got.items()}
    assert turns == {1: [("user", "q"), ("assistant", "")], 2: [("user", "q"), ("assistant", "a")], 3: [("user", "q"), ("assistant", "a")], 4: [("user", "q"), ("assistant", "a")], 5: [("user", "s\n\nq"), ("assistant", "a")], 6: [], 7: None, 8: None, 9: None}
    assert got[7].layout is None and got[7].fingerprint is not None and got[8].fingerprint is None
    assert len({got[i].fingerprint for i in (1, 2, 3, 4, 5)}) == 5


def test_chat_layouts_of_records_with_other_fields(spark):
    pair = [("user", "q"), ("assistant", "a")]
    records = [
        ({"id": "x", "messages": [{"role": "user", "content": "q", "name": "bob"}, {"role": "assistant", "content": "a", "tool_calls": [{"f": {"g": 1}}]}]}, "messages", pair),
        ({"prompt": "q", "completion": "a", "score": 0.5}, "prompt_completion", pair),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "GPT", "value": "a"}], "source": {"u": ["v"]}}, "conversations", pair),
        ({"conversations": [{"role": "human", "content": "q"}, {"role": "assistant", "content": "a"}]}, "conversation_roles", pair),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image", "url": "u"}]}, {"role": "assistant", "content": [{"text": "a"}]}]}, "message_parts", pair),
        ({"system": "s", "question": "q", "answer": "a"}, "question_answer", [("system", "s"), *pair]),
        ({"system_prompt": "", "instruction": "q", "input": "", "output": "a"}, "instruction_output", pair),
        ({"a b": 1, "c.d": [[{"e": 2}]], "query": "q", "response": "a"}, "query_response", pair),
        ({"messages": ["q", "a"]}, None, None),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "user", "content": ["a"]}]}, None, None),
        ({"messages": [{"role": "user", "content": {"text": "q"}}]}, None, None),
        ({"outer": {"prompt": "q", "response": "a"}}, None, None),
        ({}, None, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, *_) in enumerate(records)] + [(99, "[1, 2]"), (98, '"text"')], "conv_id long, raw string")
    got = {r.conv_id: (r.layout, None if r.turns is None else [(t.role, t.text) for t in r.turns]) for r in cf.canonical_turns(df).collect()}
    assert got == {i: (name, turns) for i, (_, name, turns) in enumerate(records)} | {99: (None, None), 98: (None, None)}
    same = spark.createDataFrame([(1, '{"prompt": "x", "id": 1, "response": "y"}'), (2, '{"response": null, "id": "z", "prompt": "q"}'), (3, '{"prompt": "x", "response": "y"}')], "conv_id long, raw string")
    a, b, c = (r.fingerprint for r in cf.canonical_turns(same).orderBy("conv_id").collect())
    assert a == b != c


@pytest.mark.parametrize("long", [10_000_000, 0])
def test_chat_loses_no_text_without_a_word(spark, monkeypatch, long):
    monkeypatch.setattr(cf, "LONG", long)
    q, a, pair = {"role": "human", "content": "q"}, {"role": "AI", "content": "a"}, [("user", "q"), ("assistant", "a")]
    parts = [{"type": "text", "text": "a"}]
    records = [
        ({"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("system", "s"), *pair], []),
        ({"system_prompt": "s", "system": "t", "messages": [q, a]}, [("system", "t"), *pair], ["system_prompt"]),
        ({"instruction": "q", "output": "a", "history": [["x", "y"], ["z", "w"]]}, [("user", "x"), ("assistant", "y"), ("user", "z"), ("assistant", "w"), *pair], []),
        ({"instruction": "q", "output": "a", "history": []}, pair, []),
        ({"instruction": "q", "output": "a", "history": [["x", "y", "z"]]}, pair, ["history[][]"]),
        ({"question": "q", "context": "c", "answer": "a"}, [("user", "q\n\nc"), ("assistant", "a")], []),
        ({"prompt": "p", "response": "r", "messages": [q, a]}, pair, ["prompt", "response"]),
        ({"messages": [q, {"role": "assistant", "content": parts}]}, pair, []),
        ({"messages": [q, {"role": "assistant", "content": [*parts, {"type": "image", "url": "u"}]}]}, pair, ["messages[].content"]),
        ({"messages": [{"role": "user", "content": [{"text": "q"}, {"image": "i"}]}, {"role": "assistant", "content": parts}]}, pair, ["messages[].content[].image", "messages[].content[].type"]),
        ([q, a], pair, []),
        ({"chosen": [q, a], "rejected": [q, {"role": "ai", "content": "b"}]}, pair, ["rejected[].content", "rejected[].role"]),
        ({"inputs": "q", "targets": "a", "id": "7"}, pair, ["id"]),
        ({"turns": [{"role": "bot", "text": "x"}]}, [("bot", "x")], []),
        ({"messages": ["q", {"role": "user", "content": "x"}]}, None, ["messages[]"]),
        ({"text": "t", "n": 1}, None, ["text"]),
        ({"prompt": ["q"], "response": "a"}, None, ["prompt[]", "response"]),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, *_) in enumerate(records)], "conv_id long, raw string")
    got = {r.conv_id: (None if r.turns is None else [(t.role, t.text) for t in r.turns], r.unmapped) for r in cf.canonical_turns(df).collect()}
    for i, (record, turns, unmapped) in enumerate(records):
        assert got[i] == (turns, unmapped), record


def test_chat_of_thousands_of_turns(spark):
    n = 8_000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn </turn> "), F.col("id").cast("string")).alias("text"))
    began = time.perf_counter()
    got = cf.digests(cf.format_chats(cf.as_records(cf.gather_turns(df)))).first()
    loss = "".join(f"turn </turn> {k}" for k in range(1, n, 2))
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (n, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert time.perf_counter() - began < 30


TEXTS = ["", "plain", "</turn>", "</turn>\n<turn user>\n", "<\\/turn>", "<\\\\/turn>\\", "\\### Assistant: </turn> ok", "a <turn x>\n</turn", "<", "<\\", "<turn", "é𝄞中" * 50, "\n\n", "x" * 50_000, "$1 \\1 \\$"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate((r, x) for x in TEXTS for r in ("user", "assistant", "to ol>\n", ""))]
    rows += [(7, None, None, None), (None, 1, "user", "u"), (None, 0, "assistant", "a"), (8, 1, "assistant", "b"), (8, 1, "assistant", "a"), (8, 1, "assistant", "a")]
    gathered = cf.gather_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    out = cf.format_chats(cf.as_records(gathered))
    got = {r.conv_id: r for r in cf.digests(out).collect()}
    for r in gathered.collect():
        flat = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        loss = "".join(t.text for t in r.turns if t.role == "assistant")
        g = got[r.conv_id]
        assert (g.n_turns, g.turns_sha256) == (len(r.turns), hashlib.sha256(flat.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    read = out.select("conv_id", "formatted", "loss_mask", cf.read_turns(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: r.turns for r in read} == {r.conv_id: r.turns for r in gathered.collect()}
    assert all(sum(m.chars for m in r.loss_mask) == len(r.formatted) for r in read)
    assert cf.digests(cf.format_chats(cf.as_records(gathered.where("false")))).count() == 0


@pytest.mark.parametrize("n", [2, 3])
def test_chat_text_beyond_a_variant(spark, n):
    rows = [(0, "user", "q"), (1, "assistant", '\\"{"role": ' + "x" * 20_500_000), (2, "user", "</turn>")][:n]
    given = spark.createDataFrame([(t, role, text[:11]) for t, role, text in rows], "turn long, role string, head string")
    df = given.select(F.lit(1).alias("conv_id"), "turn", "role", F.when(F.col("turn") == 1, F.concat("head", F.expr("repeat('x', 20500000)"))).otherwise(F.col("head")).alias("text"))
    got = cf.digests(cf.format_chats(cf.as_records(cf.gather_turns(df)))).first()
    flat = "".join(f"{role}\n{text}\n" for _, role, text in rows)
    assert (got.n_turns, got.turns_sha256) == (n, hashlib.sha256(flat.encode()).hexdigest())
    assert (got.loss_chars, got.loss_sha256) == (len(rows[1][2]), hashlib.sha256(rows[1][2].encode()).hexdigest())


def test_chat_long_records_read_as_short_ones(spark, monkeypatch):
    texts = [t for t in TEXTS if len(t) < 1000] + ['"', '\\"', '\\\\"', '": "', '{"role": "x"}', "\\", 'a"b:c', "1.50"]
    records = [json.dumps({"messages": [{"role": r, "content": t} for t in texts for r in ("user", t)]}, ensure_ascii=k) for k in (True, False)]
    records += [json.dumps({"conversations": [{"from": "human", "value": t} for t in texts]}, indent=1), json.dumps({"prompt": texts[-3], "response": "\\"}), '{"pro\\u006dpt" : 1.50, "response":null}', '{"instruction": true, "input": "", "output": "\\\\"}']
    records += ['{"messages": []}', '{"messages": [{"role": "a", "content": {"x": "y"}}]}', '{"a\\"b": ["c", "d:"]}', "no json", '{"prompt": "', '"only text"', None]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, raw string")
    short = cf.canonical_turns(df).orderBy("conv_id").collect()
    assert [r.layout for r in short] == ["messages", "messages", "conversations", "prompt_response", "prompt_response", "instruction_output", "messages"] + [None] * 6
    monkeypatch.setattr(cf, "LONG", 0)
    assert cf.canonical_turns(df).orderBy("conv_id").collect() == short
    with pytest.raises(Exception, match="(?i)malformed"):
        cf.canonical_turns(spark.createDataFrame([(1, '{"prompt": "\\q", "response": "a"}')], "conv_id long, raw string")).collect()
    monkeypatch.setattr(cf, "MOST_BLANKED", 3)
    with pytest.raises(Exception, match="does not fit a variant"):
        cf.canonical_turns(spark.createDataFrame([(1, '{"prompt": ')], "conv_id long, raw string")).collect()


def test_chat_query_has_the_planted_conversation(spark, sf):
    r = queries.op3_chat_format(spark, sf).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert r.n_turns == 2 and r.loss_chars == len(text) and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


# ---- URL filters ----------------------------------------------------------------------------------------------------


def brute_filter(captures, entries):
    """Entries: list, kind, pattern, action, day. Captures: id, url, day."""
    import re

    changes = {}
    for name, kind, pattern, action, day in entries:
        if None in (name, kind, pattern, action, day):
            continue
        at = changes.setdefault((name, kind, pattern.lower()), {})
        at[day] = at.get(day, False) or action == "remove"
    out = []
    for i, url, day in captures:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(/[^?#]*)?", (url or "").strip(" "))
        host = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", m[1])).lower().rstrip(".") if m else ""
        keys = set()
        if host and day is not None:
            labels = host.split(".")
            keys = {".".join(labels[k:]) for k in range(len(labels))}
            steps = [x for x in (m[2] or "").split("/") if x]
            keys |= {(host + "/" + "/".join(steps[: k + 1])).lower() for k in range(len(steps))}
        active = []
        for (name, kind, pattern), at in changes.items():
            before = [d for d in at if day is not None and d <= day]
            if pattern in keys and before and not at[max(before)]:
                active.append((len(pattern), kind == "allow", pattern, name))
        best = max(active)[:3] if active else None
        out.append((i, host or None, bool(best) and not best[1], len(active), best[2] if best else None, ",".join(sorted({a[3] for a in active}))))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_filters_equal_brute_force(spark, monkeypatch, broadcast):
    import random
    from datetime import datetime, timedelta

    from tripforge.llm import url_filters

    if not broadcast:
        monkeypatch.setattr(url_filters, "BROADCAST_INTERVALS", -1)
    rng = random.Random(3)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "d.org", "com"]
    entries = [(rng.choice("LMN"), "block", rng.choice(hosts + ["a.com/x", "a.com/x/y", "B.A.com/x"]), rng.choice(["add", "add", "remove"]), rng.randrange(20)) for _ in range(60)]
    entries = [(n, "allow" if n == "N" else k, p, a, d) for n, k, p, a, d in entries] + [("L", "block", None, "add", 1), ("L", "block", "d.org", "add", None)]
    urls = ["http://a.com/x/y", "https://u:p@B.a.com:8080/x?q#f", "http://c.b.a.com", "http://d.org./", "http://xa.com/x", None, "", "no url", "ftp://d.org//x", " http://a.com/X "]
    captures = [(k, rng.choice(urls), rng.choice([*range(22), None])) for k in range(200)] + [(7, "http://a.com/x", 5)] * 2
    day = lambda d: None if d is None else datetime(2024, 1, 1) + timedelta(days=d)
    c = spark.createDataFrame([(i, u, day(d), "clash") for i, u, d in captures], "capture_id long, url string, fetched_at timestamp, key string")
    e = spark.createDataFrame([(n, k, p, a, day(d)) for n, k, p, a, d in entries], "list string, kind string, pattern string, action string, since timestamp")
    got = [(r.capture_id, r.host, r.blocked, r.n_active, r.pattern, ",".join(r.lists)) for r in filter_urls(c, e).collect()]
    assert sorted(got, key=str) == sorted(brute_filter(captures, entries), key=str)
    assert filter_urls(c.where("false"), e).count() == 0 and {r.blocked for r in filter_urls(c, e.where("false")).collect()} == {False}


def test_url_filters_of_very_long_urls(spark):
    """A megabyte of path, of host, of slashes; prefixes that end at the longest pattern's length."""
    long = "http://a.b.example.org/en/docs/" + "seg/" * 250_000
    rows = [(1, long), (2, "http://" + "x." * 200_000 + "example.org/"), (3, "http://a.b.example.org" + "/" * 500_000 + "EN/docs"), (4, "http://example.org/en/docsmore"), (5, "http://example.org/en/docs?q=" + "y" * 100_000), (6, "http://example.org/en/doc")]
    captures = spark.createDataFrame([(i, u, None) for i, u in rows], "capture_id long, url string, list string").withColumn("fetched_at", F.timestamp_seconds(F.lit(1_000)))
    entries = spark.createDataFrame([("l", "block", "example.org/en/docs", "add"), ("m", "allow", "a.b.example.org/en", "add")], "list string, kind string, pattern string, action string").withColumn("since", F.timestamp_seconds(F.lit(0)))
    began = time.perf_counter()
    got = {r.capture_id: (r.blocked, r.pattern) for r in filter_urls(captures, entries).collect()}
    assert got == {1: (False, "a.b.example.org/en"), 2: (False, None), 3: (False, "a.b.example.org/en"), 4: (False, None), 5: (True, "example.org/en/docs"), 6: (False, None)}
    assert time.perf_counter() - began < 30


def test_intervals(spark):
    rows = [("L", "block", "a", "add", 1), ("L", "block", "a", "add", 2), ("L", "block", "a", "remove", 5), ("L", "block", "a", "remove", 6), ("L", "block", "a", "add", 9), ("L", "block", "a", "add", 12), ("L", "block", "a", "remove", 12)]
    df = spark.createDataFrame(rows, "list string, kind string, pattern string, action string, d int").withColumn("since", F.timestamp_seconds(F.col("d")))
    got = validity_intervals(df).select(F.unix_seconds(F.col("since").cast("timestamp_ltz")).alias("a"), F.unix_seconds(F.col("until").cast("timestamp_ltz")).alias("b")).orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(1, 5), (9, 12)]


def test_hosts(spark):
    df = spark.createDataFrame([("HTTP://User@Ex.COM:80/p",), ("//x/y",), (None,)], "u string")
    assert [r.h for r in df.select(host_of(F.col("u")).alias("h")).collect()] == ["ex.com", None, None]
