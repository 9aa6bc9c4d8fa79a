"""The training-data operators against plain versions, on the small documents and on odd rows."""

import base64
import collections
import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floorlens.llm import arc, byte_bpe, crf, flat_graph, interleave, lsh_forest, packing, ppm, quality, url_rules
from floorlens.session import BATCH_BYTES

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "A B C D E F"),
    (None, "a b c"), (7, "word " * 3000), (8, "x" * 20_000), (9, "É ü ß 中文 😀\n\n  two  blanks \x1c end"), (10, "###  $$$"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(i, t, "en", None if k % 2 else "s", k, "clash") for k, (i, t) in enumerate(ODD)],
        "doc_id long, text string, lang string, source string, ids int, body string",
    )


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")


def words(text):
    return (text or "").encode().lower().split()


def test_bpe_agrees_with_tiktoken_and_decodes(documents, odd, empty):
    path = public_tokenizers.path(byte_bpe.RANKS)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (documents, odd):
        given = [(r.doc_id, r.text or "") for r in docs.collect()]
        got = byte_bpe.decode(byte_bpe.encode(docs, path), path).collect()
        assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in got) == sorted(
            (str(i), plain.encode_ordinary(t), t.encode()) for i, t in given
        )
    assert byte_bpe.encode(empty, path).count() == 0


def test_packing_holds_every_id_once_with_little_padding(documents, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    for docs in (documents, odd.where("doc_id <> 5")):
        rows = packing.packed(docs, path).collect()
        by_doc, by_sequence = collections.defaultdict(dict), collections.defaultdict(dict)
        for r in rows:
            ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
            assert len(ids) == r.length
            by_doc[r.doc_id][r.start] = ids
            by_sequence[r.sequence_id][r.offset] = r.length
        for r in docs.collect():
            want = plain.encode(r.text or "", add_special_tokens=False).ids + [1]
            assert [i for _, part in sorted(by_doc[r.doc_id].items()) for i in part] == want
        for parts in by_sequence.values():
            total = 0
            for offset, length in sorted(parts.items()):
                assert offset == total
                total += length
            assert total <= 2048
    assert packing.packed(empty, path).count() == 0


def test_differencing_deals_each_item_once():
    draw = random.Random(3)
    sizes = [draw.randint(1, 512) for _ in range(400)]
    dealt = packing.pack(sizes, 2048)
    assert sorted(i for w in dealt for i in w) == list(range(400))
    assert max(sum(sizes[i] for i in w) for w in dealt) <= 2048
    assert len(dealt) <= -(-sum(sizes) // 2048) + 2


def test_archives_round_trip(spark):
    long = "<p>" + "é" * 200
    rows = [(3, "http://a b/", long), (1, None, long), (2, "http://c/", None), (4, "http://d/", "short"), (5, "u", "short"), (None, "v", long), (1, "w", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = arc.parse_warc(arc.convert(arc.write_arc(pages))).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = next((h or "").encode() for p, u, h in rows if p == r.page_id and len((h or "").encode()) == r.payload_bytes)
        assert r.payload_digest == hashlib.sha256(payload).hexdigest()
        later = len(payload) >= 100 and r.page_id != 1
        assert (r.record_type, r.refers_to) == (("revisit", 1) if later else ("response", None))
    assert arc.parse_warc(arc.convert(arc.write_arc(pages.limit(0)))).count() == 0


def test_declared_lengths_are_obeyed_in_both_versions():
    for version in (1, 2):
        block = b"X-Page-Id: 1\r\n\r\n" + b"http://fake 0.0.0.0 1 text/html 3\nabc"
        data = arc.version_block(version) + arc.arc_record(version, "u", b"", block) + arc.arc_record(version, "v", b"", b"")
        assert [(f["URL"], b) for f, b in arc.read_arc(data)] == [("u", block), ("v", b"")]


def test_quality_measurements(documents, odd, empty):
    for docs in (documents, odd):
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        for r in quality.judge(docs).collect():
            text = texts[r.doc_id]
            own = text.encode().split()
            lines = [x for x in text.split("\n") if x.encode().split()]
            count = collections.Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
            covered = {j for i in range(len(own) - 2) if count[tuple(own[i : i + 3])] > 1 for j in range(i, i + 3)}
            assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(own), sum(len(w.decode()) for w in own), len(covered))
            assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
            assert r.base_failed == (len(own) < 50 or 100 * len(covered) > 50 * len(own))
            assert not (r.base_failed and r.kept)
    assert quality.judge(empty).count() == 0
    assert quality.accept(odd).columns == odd.columns


def test_ablations_count_lone_failures(documents):
    rows = quality.ledger(documents)
    found = {r.rule: r for r in quality.ablations(rows).collect()}
    fails = [r.fails for r in rows.collect()]
    for bit, rule in enumerate(quality.RULES):
        assert found[rule].failed == sum(bool(f >> bit & 1) for f in fails)
        assert found[rule].failed_alone == sum(f == 1 << bit for f in fails)


def test_url_rules_explicit_and_mined(spark):
    urls = [
        "http://EXAMPLE.org/es/x", "http://a.example.org/en/12?q", "https://b.com/de/#x", "x.com/fr/", None, "http://badorg/", "http://org",
    ]
    urls += [f"http://spam.net/win/{i}" for i in range(60)] + [f"http://fine.net/win/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int("spam" not in (u or "")), 0) for i, u in enumerate(urls) if 7 <= i and i % 60 != 10], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, labels).collect()}
    assert [got[i] for i in range(7)] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/de/", "block"), (None, "allow"), (None, "allow"),
        (None, "allow"), (None, "allow"),
    ]
    assert all(got[i] == (None, "block" if "spam" in urls[i] else "allow") for i in range(7, len(urls)))
    assert url_rules.judge(pages.limit(0), labels.limit(0)).count() == 0


def test_language_of_held_out_documents(documents, odd, empty):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    field = crf.fit(documents, ~held)
    got = crf.predict(documents.where(held), field).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    strange = {(r.doc_id, r.lang_pred) for r in crf.predict(odd, field).collect() if r.lang_pred == "und"}
    assert {i for i, _ in strange} == {1, 2, 3, 10}
    assert crf.predict(empty, field).count() == 0
    assert {r.lang_pred for r in crf.predict(odd, crf.fit(empty, F.lit(True))).collect()} == {"und"}


def test_language_gets_batches_by_bytes_and_each_text_once(spark, documents, odd):
    """Before, a worker got 10,000 texts at a time, those of ``accept`` twice."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        got = crf.accept(documents)
        sent = got._jdf.queryExecution().analyzed().children().head()
        assert list(sent.schema().fieldNames()) == documents.columns

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

        long = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
        found = [r.size for r in long.mapInArrow(sizes, "size long").collect()]
        assert max(found) < 1.2 * BATCH_BYTES and sum(found) > 6 * BATCH_BYTES
        best = crf.predict(documents, crf.fit(documents, F.lit(True))).where("lang_pred <> 'und' AND score >= 0.35").select("doc_id")
        assert sorted(map(str, got.collect())) == sorted(map(str, documents.join(best, "doc_id", "left_semi").select(*documents.columns).collect()))
        kept = crf.accept(odd)
        assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, 7, 8, 9}
    finally:
        spark.conf.unset(name) if held is None else spark.conf.set(name, held)


def test_language_of_new_words_is_found_some_words_at_a_time():
    """Memory follows the words of a run; before, features of all new words of 2 MB were made at once."""
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(1000)) for _ in range(200)]
    field = crf.train([("a", 0, "one two three"), ("b", 1, "vier sechs acht")])
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tracemalloc.start()
    rows = [(names.tolist(), scores.tolist()) for _, names, scores, _ in crf.judge(iter([batch]), "text", field)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(names) for names, _ in rows) == 200 and all(0.5 <= x <= 1 for _, scores in rows for x in scores)
    assert most < 150e6


def test_shards_follow_the_mixture(documents, odd, empty):
    rows = interleave.interleaved(documents).toPandas()
    counts = rows.groupby("shard").size()
    assert len(counts) == 16 and counts.max() - counts.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    mix = rows.groupby(["stratum", "shard"]).size().unstack(fill_value=0)
    assert ((mix.max(axis=1) - mix.min(axis=1)) <= 2).all()
    assert interleave.interleaved(odd).count() == len(ODD)
    assert interleave.interleaved(empty).count() == 0


def plain_components(docs, width):
    sets = {}
    for i, text in docs:
        own = words(text)
        sets[i] = {tuple(own[k : k + width]) for k in range(len(own) - width + 1)} or ({tuple(own)} if own else set())
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_agree_with_all_pairs(documents, odd, empty):
    for docs, width in ((documents, 4), (odd.where("doc_id IS NOT NULL"), 5)):
        want = plain_components([(r.doc_id, r.text) for r in docs.collect()], width)
        got = lsh_forest.near_duplicates(docs, width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert lsh_forest.near_duplicates(empty).count() == 0
    assert sum(r.doc_id is None for r in lsh_forest.accept(odd).collect()) == 1


def test_vectors_agree_with_brute_force():
    draw = np.random.default_rng(1)
    base = draw.normal(size=(150, 32))
    x = np.concatenate([base, base + draw.normal(scale=0.2, size=base.shape), base[:40] + draw.normal(scale=0.1, size=(40, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = flat_graph.adjacency(pa.table({"item": pa.array(range(len(x))), "vector": pa.array(x.tolist(), pa.list_(pa.float64()))}))
    near = [np.array(a) for a in table.column("near").to_pylist()]
    a, b = flat_graph.found_links(x, near, 0.93)
    truth = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    assert truth[a, b].all() and len(set(zip(a.tolist(), b.tolist()))) >= 0.97 * truth.sum()


def plain_lengths(texts, training):
    """log10 of the probability of each text by a trie of dictionaries over the whole training texts."""
    line = lambda text: b" " + b"".join(w + b" " for w in words(text)) + b" "
    contexts = collections.defaultdict(collections.Counter)
    for text in training:
        data = line(text)
        for p in range(1, len(data)):
            for j in range(min(ppm.ORDER, p) + 1):
                contexts[data[p - j : p]][data[p]] += 1

    def code(text):
        data, out = line(text), 0.0
        for p in range(1, len(data)):
            hidden = set()
            for j in range(min(ppm.ORDER, p), -1, -1):
                seen = contexts.get(data[p - j : p], {})
                left = {s: n for s, n in seen.items() if s not in hidden} if hidden else seen
                if data[p] in left:
                    out += math.log10((2 * left[data[p]] - 1) / (2 * sum(left.values())))
                    break
                if left:
                    out += math.log10(len(left) / (2 * sum(left.values())))
                hidden |= set(left)
            else:
                out -= math.log10(256 - len(hidden))
        return out

    return [code(t) for t in texts]


@pytest.mark.parametrize("small", [False, True])
def test_partial_matching_agrees_with_a_plain_trie(spark, documents, odd, empty, monkeypatch, small):
    if small:  # several blocks, buckets and groups
        for name, size in (("BLOCK_BYTES", 3000), ("ENTRIES", 500), ("GROUP", 300)):
            monkeypatch.setattr(ppm, name, size)
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    some = documents.where("length(text) < 4000").orderBy("doc_id").limit(25).select("doc_id", "text")
    for docs in (some, odd.select("doc_id", "text")):
        given = [(r.doc_id, r.text) for r in docs.collect()]
        learned = [t for i, t in given if i is not None and zlib.crc32(str(i).encode()) % 10]
        counts = collections.Counter(w for t in learned for w in words(t) + [b""])
        total, kinds = sum(counts.values()), len(counts)
        unigram = lambda own: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        lengths = plain_lengths([t for _, t in given], learned)
        want = sorted((str(i), len(words(t)) + 1, sum(counts[w] > 0 for w in words(t) + [b""]), score, unigram(words(t) + [b""]))
                      for (i, t), score in zip(given, lengths))
        got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.score, r.base_score) for r in ppm.scored(docs, training).collect())
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [x for g in got for x in g[3:]] == pytest.approx([x for w in want for x in w[3:]], rel=1e-9)
    assert ppm.scored(empty, training).count() == 0
    untrained = ppm.scored(odd, F.lit(False)).where("doc_id = 4").first()
    assert untrained.score == pytest.approx(-5 * math.log10(256)) and untrained.train_tokens == 0


def test_partial_matching_minds_the_order_of_words(spark):
    rows = [(1, "the cat sat on the mat"), (2, "mat the on sat cat the"), (3, "the cat sat on the mat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in ppm.scored(docs, F.col("doc_id") == 1).collect()}
    assert score[1] == score[3] > score[2] + 1


def test_byte_strings_do_not_depend_on_the_stretch():
    lines = ppm.lines_of(pa.array(["", "ab  c", "x" * 20, "A\nÉ中", " "]))[0]
    assert lines.to_pylist() == ["  ", " ab c  ", " " + "x" * 20 + "  ", " a É中  ", "  "]
    whole = [np.concatenate(c).tolist() for c in zip(*ppm.windows(lines))]
    data = [line.encode() for line in lines.to_pylist()]
    plain = [(i, int.from_bytes(b"\1" + d[max(0, p - ppm.ORDER) : p + 1], "big")) for i, d in enumerate(data) for p in range(1, len(d))]
    assert list(zip(*whole)) == plain
    for width in (1, 2, 3, 7, 11):
        assert [np.concatenate(c).tolist() for c in zip(*ppm.windows(lines, width))] == whole
    held = ppm.Strings()
    held.add(lines, np.array([True, True, False, True, True]), 3)
    strings, counts = held.all()
    met = collections.Counter(s for i, s in plain if i != 2)
    assert dict(zip(strings.tolist(), counts.tolist())) == {s: met[s] for _, s in plain}
    assert ppm.unpacked_strings(ppm.packed_strings(strings), len(strings)).tolist() == strings.tolist()
