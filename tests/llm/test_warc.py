import base64
import hashlib

import pytest
import zstandard

from tidemark.llm import warc


def brute(pages):
    best = {}
    for page, _, html in pages:
        payload = (html or "").encode()
        if page is not None:
            best[payload] = min(best.get(payload, page), page)
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = best.get(payload)
        again = first is not None and (page is None or page > first)
        out.append((page, len(payload), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


PAGES = [
    (3, "http://a/x", "<p>é</p>"), (1, "http://a/y", "<p>é</p>"), (1, "http://a/y", "<p>é</p>"), (2, None, None), (5, "", ""), (None, "http://b/\n c", "<p>é</p>"),
    (None, None, "lone"), (7, "http://c", "x\r\n\r\ny" * 3), (8, "http://d", "w" * 300_000),
]


def result(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_round_trip(frame, speak):
    pages = PAGES + [(100 + i, f"http://e/{i}", "<html>" + " ".join(speak(400)) + "</html>") for i in range(200)]
    rows = warc.round_trip(frame(pages, "page_id long, url string, html string")).collect()
    assert result(rows) == brute(pages)
    texts = {p: h for p, _, h in pages}
    assert all(r.payload.decode() == (texts[r.page_id] or "") for r in rows if r.record_type == "response" and r.page_id is not None)


def test_empty_and_clashing(frame):
    assert warc.round_trip(frame([], "page_id long, url string, html string")).collect() == []
    rows = frame([(1, "u", "h", 1, 2)], "page_id long, url string, html string, n int, sha int")
    assert [r.page_id for r in warc.round_trip(rows).collect()] == [1]


def test_the_dictionary_comes_from_the_leading_frame():
    texts = [f"<html><body>common words here {i}</body></html>".encode() * 3 for i in range(200)]
    raw = zstandard.train_dictionary(2048, texts).as_bytes()
    one = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    frames = [one.compress(t) for t in texts]
    for stored in (raw, zstandard.ZstdCompressor().compress(raw)):
        assert list(warc.frames(warc.skippable(stored) + b"".join(frames))) == texts
    with pytest.raises(warc.WarcError):
        list(warc.frames(b"".join(frames)))


@pytest.mark.parametrize("harm", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/9"), lambda d: d[:-1], lambda d: d.replace(b"WARC-Date", b"WARC-Gate"), lambda d: d.replace(b"<p>", b"<q>"),
    lambda d: d.replace(b"sha1:", b"md5:"), lambda d: d + b"x", lambda d: d.replace(b"response\r\nWARC-Rec", b"metadata\r\nWARC-Rec"),
])
def test_broken_records_are_told(harm):
    good = warc.record(1, "http://a", b"<p>text</p>", None)
    assert warc.parse(good)["payload"] == b"<p>text</p>"
    with pytest.raises(warc.WarcError):
        warc.parse(harm(good))


def test_a_cut_archive_is_told():
    data = warc.skippable(b"") + zstandard.ZstdCompressor().compress(warc.record(1, None, b"x" * 1000, None))
    assert len(list(warc.frames(data))) == 1
    with pytest.raises(warc.WarcError):
        list(warc.frames(data[:-3]))
