import hashlib

import pyarrow.fs
import pytest

from candlewick.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, record_type int"


def brute(rows, least=100):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        first = min(same, default=None) if len(data) >= least else None
        refers = first if first is not None and first != page_id else None
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(map(str, out))


def pages_of():
    long, short = "<p>é" + "x" * 200, "<p>short</p>"
    rows = [(i, f"http://h/{i}", f"<html><p>page {i} " + "word " * i) for i in range(80)]
    rows += [(200, "http://a\r\nb c", long), (150, None, long), (150, "u", long), (151, "u", long), (None, "n", long)]
    rows += [(300, "s", short), (301, "s", short), (302, "e", None), (303, "e", ""), (None, None, None)]
    rows += [(None, "q", "z" * 500), (None, "q", "z" * 500), (400, "big", "big " * 300_000)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, tmp_path, monkeypatch, small):
    if small:  # many files, many reads a record
        monkeypatch.setattr(warc, "FILE_BYTES", 3000)
        monkeypatch.setattr(warc, "READ", 64)
    rows = pages_of()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    files = warc.write_archives(frame, str(tmp_path / "w"))
    assert sum(f.records for f in files.collect()) == len(rows)
    got = warc.read_archives(files).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == brute(rows)
    texts = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.page_id, bytes(r.payload)) in texts for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_files_follow_the_format(spark, tmp_path):
    frame = spark.createDataFrame([(*r, "x", 1) for r in pages_of()], SCHEMA)
    path = warc.write_archives(frame, str(tmp_path / "w")).first().path
    store, name = pyarrow.fs.FileSystem.from_uri(path)
    data = store.open_input_file(name).read()
    assert data[:4] == bytes.fromhex("5d2a4d18")  # the skippable frame's magic number, low byte first
    records = list(warc.frames(data))
    assert all(r.startswith(b"WARC/1.1\r\nWARC-Type: ") and r.endswith(b"\r\n\r\n") for r in records)
    with pytest.raises(ValueError):
        list(warc.frames(data[:-5]))
    with pytest.raises(ValueError):
        warc.parse_record(records[0][:-6])


def test_dictionary_helps():
    import zstandard

    page = b"<html><nav>" + b"".join(b"<a href=/%d>menu %d</a>" % (i, i) for i in range(30))
    samples = [page + b"<p>%d text %d</p>" % (i, i * i) for i in range(400)]
    kind = zstandard.ZstdCompressionDict(warc.build_dictionary(samples))
    with_it = len(zstandard.ZstdCompressor(dict_data=kind).compress(samples[5]))
    assert with_it * 2 < len(zstandard.ZstdCompressor().compress(samples[5]))
    assert warc.build_dictionary([b"one"]) == b"one"


def test_empty(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    assert warc.write_archives(frame, str(tmp_path / "w")).count() == 0
    assert warc.archived(frame).count() == 0
