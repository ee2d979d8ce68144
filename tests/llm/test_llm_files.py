"""WARC archives, token records, packing, tokens: round trips, damage, odd rows."""

import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from areapulse.llm import packing, queries, records, tokens, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    "", "a", " a  b", "two words", "It's we'll don't. I'm\nok", "a <|endoftext|> b", "a<|endoftext|>", "é.\nÉa b, c", "a \nb",
    "x!! y?? .. , .", "中文 漢字。 ñ", "ab1 2c 3.4 5,6 a.b. c", "tab\tand\r\nline  end ", "a,\nb.\nc d", "word " * 3000,
]


def odd_documents(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (100, None, None, None, None), (None, "no id", "en", "s", 5), rows[3], rows[3]], DOCS).repartition(3)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def whole(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_word_cache_gives_the_library_ids(tokenizer):
    rng = random.Random(3)
    parts = ["the", "The", "é", "word.", "x,", "\n", "a.\nB", "  ", "\t", "12", "'s", "<|endoftext|>", "Ɐb", "ñ!", "..."]
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"), cached_words=8)
    for text in [*TEXTS, *(" ".join(rng.choices(parts, k=9)) for _ in range(400))]:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == whole(tokenizer, text, 0)[:-1], text


def plain_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(bins) if r >= length]
        if fitting:
            tightest = min(fitting, key=lambda i: bins[i])
            bins[tightest] -= length
        else:
            bins.append(capacity - length)
    return sorted(bins)


def test_words_of_one_shape_share_the_ids_of_their_parts(tokenizer, monkeypatch):
    encoder, parts = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json")), []
    part = encoder._part
    monkeypatch.setattr(encoder, "_part", lambda text: parts.append(text) or part(text))
    stems = ["wört", "plain", "Été", "ǅabc", "x"]
    words = [s + m for s in stems for m in ("", ".", "***", "!?", "'", "'s", "“", ".\nplain", "***\nwört,", "\nx", "'\ns", "1.", "\n***", "%%\n")]
    text = "start " + " ".join(words * 2)
    assert encoder.encode(text) == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    # marks and line breaks are encoded once, however many words they follow
    assert all(parts.count(p) == 1 for p in ("***", "!?", "'", "\n", ".")) and not {" wört***", " wört!?"} & set(parts)


def test_words_with_marks_take_no_room_from_their_stems(tokenizer):
    encoder = tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"), cached_words=20)
    marks = [f"{a}{b}{c}" for a in ".,!" for b in "?;%" for c in ")]}"]
    text = "start " + " ".join(s + m for m in ("", *marks) for s in ("wört", "plain", "Été"))
    assert encoder.encode(text) == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert set(encoder.words) == {"wört", "plain", "Été"} and not encoder.old


def test_grouped_best_fit_equals_piece_by_piece():
    rng = random.Random(1)
    for capacity in (1, 7, 30, 64):
        for _ in range(60):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
            fill = defaultdict(list)
            for p in packing.best_fit(dict(Counter(lengths)), capacity):
                for n in range(p.each * p.bins):
                    fill[p.first_bin + n // p.each].append((p.offset + n % p.each * p.length, p.length))
            for parts in fill.values():
                at = 0
                for offset, length in sorted(parts):
                    assert offset == at
                    at += length
            assert sorted(capacity - sum(n for _, n in parts) for parts in fill.values()) == plain_best_fit(lengths, capacity)


def test_capacity_tree_finds_the_tightest():
    rng, held = random.Random(2), Counter()
    tree = packing.CapacityTree(37)
    for _ in range(500):
        r = rng.randint(0, 37)
        held[r] += 1
        tree.add(r, 1)
        length = rng.randint(1, 37)
        assert tree.tightest(length) == min((k for k, n in held.items() if n and k >= length), default=None)
        if rng.random() < 0.7 and held[r]:
            held[r] -= 1
            tree.add(r, -1)


def test_packed_pieces(spark, tokenizer):
    docs = odd_documents(spark)
    rows = packing.packed(docs).collect()
    want = Counter()
    for d in docs.collect():
        ids = whole(tokenizer, d.text, 2)
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for n, start in enumerate(starts):
            part = ids[start : first if n == 0 else start + 1024]
            want[d.doc_id, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(docs.where("doc_id < 0")).count() == 0


def test_sequences_hold_the_ids_in_order(spark, tokenizer):
    stored = packing.stage(spark, packing.pieces(odd_documents(spark)), "test_pieces")
    placed = packing.stage(spark, packing.pack(stored, ["doc_id", "piece", "start", "ids"], block_rows=4), "test_placed")
    joined = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert joined[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
    assert sum(map(len, joined.values())) == sum(r.length for r in placed.collect())


def test_records_round_trip(spark, tokenizer):
    docs = odd_documents(spark)
    manifest = records.write_records(docs)
    rows = records.read_records(manifest).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == Counter(
        (d.doc_id, tuple(whole(tokenizer, d.text, 0))) for d in docs.collect()
    )
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    one = manifest.where("records > 1").first()
    listed = list(records.stored_records(one.folder, one.path))
    for n in (one.records - 1, 0):
        assert records.record_at(one.folder, one.path, one.index_path, n) == listed[n]
    assert records.read_records(records.write_records(docs.where("doc_id < 0"))).count() == 0


def test_damaged_records_are_refused():
    good = records.frame(records.serialise(5, np.array([1, 70_000], "<u4").tobytes())) + records.frame(records.serialise(None, b""))
    stream = io.BytesIO(good)
    assert [records.deserialise(records.read_frame(stream)) for _ in range(2)] == [(5, np.array([1, 70_000], "<u4").tobytes()), (None, b"")]
    assert records.read_frame(stream) is None
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        stream = io.BytesIO(bytes(bad))
        with pytest.raises(ValueError):
            while records.read_frame(stream) is not None:
                pass


class Blocks(io.BytesIO):
    """Gives a few bytes at a time."""

    def read(self, size=-1):
        return super().read(min(size, 7))


def test_archive_is_read_in_small_blocks_and_checked():
    made = [(1, "http://a/", b"<p>x</p>" * 5000, None), (2, None, b"", None), (3, "http://b/\r\nX: y", b"", 2), (None, "u", "é".encode(), None)]
    data = b"".join(warc.member(warc.record(*m, "2024-01-01T00:00:00Z")) for m in made)
    found = list(warc.read_archive(Blocks(data)))
    assert [(warc.page_of(f["warc-record-id"]), int(h["content-length"]), f["warc-type"], p) for f, h, p in found] == [
        (1, 40_000, "response", made[0][2]), (2, 0, "response", b""), (3, 0, "revisit", b""), (None, 2, "response", "é".encode()),
    ]
    for broken in (data[:-9], data[:60]):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read_archive(io.BytesIO(broken)))
    plain = warc.record(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    for broken in (plain.replace(b"payload", b"Payload"), plain.replace(b"Content-Length: 8", b"Content-Length: 7", 1), plain + b"x"):
        if broken != plain:
            with pytest.raises(ValueError):
                list(warc.read_archive(io.BytesIO(warc.member(broken))))


def test_pages_become_responses_and_revisits(spark):
    pages = spark.createDataFrame(
        [(5, "u5", "same"), (2, "u2", "same"), (9, None, None), (7, "u7", ""), (None, "n", "same"), (None, "n", "alone"), (2, "u2", "same"), (4, "u4", "x" * 300_000)],
        "page_id long, url string, html string",
    ).withColumn("refers_to", warc.F.lit(77)).repartition(3)
    read = warc.read_archives(warc.write_archives(pages)).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in read) == Counter({
        (5, "revisit", 2, 4): 1, (2, "response", None, 4): 2, (9, "revisit", 7, 0): 1, (7, "response", None, 0): 1,
        (None, "revisit", 2, 4): 1, (None, "response", None, 5): 1, (4, "response", None, 300_000): 1,
    })
    assert all(r.payload is None or warc.digest(r.payload) == r.payload_digest for r in read)
    few = warc.read_archives(warc.write_archives(pages, least_bytes=1)).where("page_id = 9").first()
    assert (few.record_type, few.refers_to) == ("response", None)
    assert warc.read_archives(warc.write_archives(pages.where("page_id < 0"))).count() == 0


def test_archive_query_equals_sql(spark):
    from areapulse.checks.compare import difference

    for name in ("op1_warc", "op3_top_k"):
        assert difference(queries.QUERIES[name](spark, FOLDER), queries.SQL[name], FOLDER) is None


def test_checksums_of_pieces_are_made_where_the_ids_are(spark):
    documents = odd_documents(spark)
    columns = ["doc_id", "piece", "start", "length"]
    ids = packing.pieces(documents, 8).collect()
    digests = packing.digests(documents, 8).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(*(r[c] for c in columns), zlib.crc32(bytes(r.ids))) for r in ids], key=key) == sorted(map(tuple, digests), key=key)
