import hashlib
import struct

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from marajo.llm import chat, warc

NASTY = st.text(alphabet=st.sampled_from(list("\\#</turn> <|:a\né")), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), max_size=5), st.integers(1, 9))
def test_hostile_turns_read_back(turns, size):
    whole, masked = "", []
    for role, text in turns:
        segment, a, b = chat.turn_segment(role, chat.escape(text))
        masked.append((len(whole) + a, len(whole) + b, text))
        whole += segment
    reader = chat.Reader()
    for at in range(0, len(whole), size):  # fed in small stretches, masks at the end
        reader.feed(whole[at : at + size], [])
    got = reader.close(1)
    assert got["n_turns"] == len(turns) and got["formatted_chars"] == len(whole)
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert all(chat.unescape(whole[a:b]) == t for a, b, t in masked)


def test_parts_become_placeholders_in_order(spark):
    schema = "conv_id long, turn long, role string, text string, start string, parts array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    part = lambda kind, **k: (kind, k.get("text"), k.get("ref"), k.get("w"), k.get("h"), k.get("s"), k.get("p"))
    parts = [part("text", text="see <|image:0|>"), part("image", ref="s3://a.png", w=900, h=448), part("text", text=" and "), part("audio", ref="b.wav", s=1.5), part("document", ref="c.pdf", p=2)]
    rows = [(1, 0, "user", "ignored", "?", parts), (1, 1, "assistant", "ok", "?", None), (None, None, None, None, None, None), (2, 0, "assistant", "a", "?", None), (2, 0, "assistant", "a", "?", None)]
    made = chat.format_turns(spark.createDataFrame(rows, schema)).collect()
    first = next(r for r in made if r.conv_id == 1 and r.turn == 0)
    assert first.segment == "### user: see \\<|image:0|><|image:0|> and <|audio:1|><|document:2|></turn>\n"
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "s3://a.png", 768), ("audio", "b.wav", 38), ("document", "c.pdf", 1200)]
    assert first.expanded_tokens == 2006
    back = {r.conv_id: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, schema))).collect()}
    assert back[1].loss_chars == 2 and back[2].n_turns == 2 and back[2].loss_sha256 == hashlib.sha256(b"aa").hexdigest() and back[None].n_turns == 1
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).collect() == []
    odd = [(1, 0, "user", None, None, [part("video", ref="v.mp4"), None, part(None), part("text", text="x")])]
    row = chat.format_turns(spark.createDataFrame(odd, schema)).first()
    assert row.segment == "### user: <|unknown:0|><|unknown:1|>x</turn>\n" and [(a.kind, a.ref, a.tokens) for a in row.attachments] == [("unknown", "v.mp4", 0), ("unknown", None, 0)]


def test_a_long_conversation(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"</turn> {i} " * (i % 50)) for i in range(20_000)]
    made = chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert made.n_turns == 20_000 and made.loss_sha256 == hashlib.sha256("".join(t for _, i, _, t in rows if i % 2).encode()).hexdigest()


PAGES = [(i, f"http://x/{i} y", f"<html>{'body ' * (50 + i)}{i}</html>") for i in range(40)] + [
    (100, None, "z" * 1000), (101, "u", "z" * 1000), (102, "u", "z" * 1000), (103, "u", "s" * 999), (104, "u", "s" * 999), (105, "u", None), (106, "u", ""), (None, "u\r\nX: y", "no id"),
    (107, "u", "é" * 60_000), (108, "dup", "z" * 1000), (108, "dup", "z" * 1000),
]


def test_round_trip_of_pages(spark):
    frame = spark.createDataFrame([(*p, "?", "?") for p in PAGES], "page_id long, url string, html string, digest string, holder string")
    rows = warc.round_trip(frame, payload=True).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted(str((i, len((h or "").encode()), sha(h), "revisit" if h == "z" * 1000 and i != 108 else "response", 108 if h == "z" * 1000 and i != 108 else None)) for i, _, h in PAGES)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows) == want
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in rows if r.record_type == "response")
    assert warc.round_trip(frame.limit(0)).collect() == []


def test_payloads_larger_than_an_archive(spark):
    rows = [(i, "u", chr(97 + i) * (50_000 * i)) for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(frame, warc.new_folder(spark, "test"), archive_bytes=60_000)
    assert sum(r.records for r in manifest.collect()) == 5 and manifest.count() > 2
    found = {r.page_id: r.payload_digest for r in warc.read_archives(manifest).collect()}
    assert found == {i: hashlib.sha1(t.encode()).hexdigest() for i, _, t in rows}


def test_invalid_records_are_reported_on_request(spark):
    pages = [f"<p>{'text ' * 40}{i}</p>".encode() for i in range(3)]
    good = [warc.record(i, None, p, hashlib.sha1(p).hexdigest(), None, "2024-01-01T00:00:00Z") for i, p in enumerate(pages)]
    bad = good[1].replace(b"text text", b"TEXT text", 1)
    root = warc.new_folder(spark, "test")
    uris = [(warc.save(root, data), "?") for data in (warc.pack([good[0], bad, good[2]], []), warc.pack(good, [])[:-9], b"")]
    manifest = spark.createDataFrame([*uris, (None, "?")], "uri string, archive string")
    told = warc.read_archives(manifest, payload=False, invalid="report").collect()
    assert sorted(r.page_id for r in told if r.problem is None) == [0, 0, 1, 2]
    assert sorted(r.archive for r in told if r.problem is not None) == sorted(u for u, _ in uris[:2])
    with pytest.raises(Exception, match="digest differs|cut off|stray"):
        warc.read_archives(manifest).collect()


def archive():
    pages = [f"<p>{'text ' * 40}{i}</p>".encode() for i in range(60)]
    records = [warc.record(i, "http://h", p, hashlib.sha1(p).hexdigest(), None, "2024-01-01T00:00:00Z") for i, p in enumerate(pages)]
    return warc.pack(records, pages), records


def test_dictionary_leads_and_frames_hold_one_record_each():
    data, records = archive()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    assert len(list(warc.unpack(data))) == len(records)
    at, n = 8 + size, 0
    while at < len(data):
        at, n = warc.frame_end(memoryview(data), at), n + 1
    assert n == len(records)
    plain = zstandard.ZstdCompressor().compress(records[0])  # archives without a dictionary are fine
    assert [r["page_id"] for r in warc.unpack(plain + plain)] == [0, 0]


@pytest.mark.parametrize("change", ["cut", "stray", "length", "digest", "ending", "type"])
def test_broken_archives_are_refused(change):
    data, records = archive()
    one = records[0]
    wrong = {
        "length": one.replace(b"Content-Length: ", b"Content-Length: 1", 1), "digest": one.replace(b"text text", b"TEXT text", 1),
        "ending": one[:-1] + b"x", "type": one.replace(b"WARC-Type: response", b"WARC-Type: rubbish"),
    }
    broken = data[:-7] if change == "cut" else data + b"abc" if change == "stray" else zstandard.ZstdCompressor().compress(wrong[change])
    with pytest.raises(warc.InvalidRecord):
        list(warc.unpack(broken))
