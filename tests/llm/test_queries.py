"""Every registered query against plain Python, on given data, edge cases and empty tables."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from oreflow.llm import toxicity
from oreflow.llm.common import Workspace
from oreflow.llm.queries import ORACLE, QUERIES, URL_RULES, tokenizer_path
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute


@pytest.fixture(params=["small", "edge"])
def folder(request):
    return SF_SMALL if request.param == "small" else request.getfixturevalue("edge_dir")


def plain(rows):
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, empty_dir, name):
    query = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    assert query(spark, empty_dir).collect() == []


def test_op1(spark, folder):
    got = QUERIES["op1_source_mix"](spark, folder).collect()
    docs = brute.rows_of(folder, "documents", "doc_id", "text", "source")
    sizes = [(s, len(brute.WORD.findall(t or ""))) for _, t, s in docs]
    of_source, target = brute.mix_targets(sizes)
    assert plain((r.doc_id, r.source, r.size) for r in got) == plain(
        (d, s, n) for (d, _, s), (_, n) in zip(docs, sizes, strict=True)
    )
    taken = Counter()
    for r in got:
        assert r.source_size == of_source[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1
    again = QUERIES["op1_source_mix"](spark, folder).collect()
    assert plain(got) == plain(again)


def test_op2(spark, folder):
    got = defaultdict(list)
    for r in QUERIES["op2_balanced_postings"](spark, folder).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    rows = brute.rows_of(folder, "embeddings", "vec_id", "embedding")
    want = brute.nearest(rows)
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and None not in v}
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert len({v for _, v, _ in found} - {q}) == len(best)
        for _, v, s in found:
            assert s == pytest.approx(float(vectors[v] @ vectors[q]), abs=1e-12)
        # Another vector of the same score is as good.
        floor = best[-1][1] - 1e-12
        hits += sum(s >= floor for _, _, s in found) / len(best)
    assert hits / len(want) >= 0.9
    if 1000 in want:
        assert [v for _, v, _ in sorted(got[1000])] == list(range(1001, 1021))


def test_op3(spark, folder):
    got = QUERIES["op3_secret_forest"](spark, folder).collect()
    texts = {i: t for i, t, _ in brute.rows_of(folder, "documents", "doc_id", "text", "lang")}
    for r in got:
        assert r.candidate in texts[r.doc_id] and 0 <= r.score <= 1
    verdicts = defaultdict(set)
    for r in got:
        verdicts[r.doc_id, r.candidate].add(r.secret)
    for i, text in texts.items():
        for key in re.findall(r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)|(?<=password=)[0-9a-f]{18}\b", text or ""):
            assert verdicts[i, key] == {True}
        for number in re.findall(r"(?<![\w.@+/-])4\d{15}(?![\w.@+/-])", text or ""):
            assert verdicts[i, number] == {False}


def test_op4(spark, folder):
    got = QUERIES["op4_url_sweep"](spark, folder).collect()
    want = [(i, *brute.judge_url(u, URL_RULES)) for i, u in brute.rows_of(folder, "pages", "page_id", "url")]
    assert plain(got) == plain(want)


def test_op5(spark, folder):
    got = QUERIES["op5_warc_chunks"](spark, folder).collect()
    want = brute.records(brute.rows_of(folder, "pages", "page_id", "html"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert plain(tuple(r[c] for c in columns) for r in got) == plain(want)
    assert all(r.chunks == max(1, -(-r.payload_bytes // (1 << 20))) for r in got if r.record_type == "response")


def test_op6(spark, folder):
    got = QUERIES["op6_risk_cutoffs"](spark, folder).collect()
    want = [(i, *brute.base_counts(t)) for i, t in brute.rows_of(folder, "documents", "doc_id", "text")]
    assert plain(tuple(r)[:-1] for r in got) == plain(want)
    assert not any(r.kept and r.base_failed for r in got)


def test_op6_keeps_good_documents_and_finds_bad_ones(spark):
    sf = "/root/testdata/sf0.1"
    kept = {r.doc_id: (r.base_failed, r.kept) for r in QUERIES["op6_risk_cutoffs"](spark, sf).collect()}
    quality = {i: q for i, q in brute.rows_of(sf, "labels", "doc_id", "quality")}
    lang = dict(brute.rows_of(sf, "documents", "doc_id", "lang"))
    passed = [i for i in quality if not kept[i][0]]
    enough = Counter(lang[i] for i in passed if quality[i])
    assert max(enough.values()) > 1000
    passed = [i for i in passed if enough[lang[i]] >= 500]
    good, bad = [i for i in passed if quality[i]], [i for i in passed if not quality[i]]
    assert sum(not kept[i][1] for i in good) <= 0.02 * len(good)
    assert sum(kept[i][1] for i in bad) <= 0.1 * len(bad)


def test_op7(spark, folder):
    got = QUERIES["op7_super_minhash"](spark, folder).collect()
    groups, sizes = brute.near_groups(brute.rows_of(folder, "documents", "doc_id", "text"))
    assert plain((r.doc_id, r.n_shingles) for r in got) == plain(sizes)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.component_id, r.kept) == (groups[r.doc_id], groups[r.doc_id] == r.doc_id)


def test_op8(spark, folder):
    got = QUERIES["op8_nnpu_toxicity"](spark, folder).collect()
    ids = Counter(i for i, _ in brute.rows_of(folder, "documents", "doc_id", "lang"))
    assert Counter(r.doc_id for r in got) == ids
    for r in got:
        assert r.held_out == brute.held_out(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


@pytest.mark.parametrize("known", ["all", "toxic"])
def test_op8_held_out(spark, tmp_path, known):
    """Labels of clean documents make no difference: with none, as much is found."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, labels if known == "all" else labels.where("toxic = 1"), Workspace(spark, "t"))
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    toxic = {i: t for i, t in brute.rows_of(sf, "labels", "doc_id", "toxic") if brute.held_out(i)}
    bad, clean = [i for i in toxic if toxic[i]], [i for i in toxic if not toxic[i]]
    assert sum(got[i].predicted for i in bad) >= 0.9 * len(bad)
    assert sum(got[i].predicted for i in clean) <= 0.02 * len(clean)
    assert 0.05 <= model.prior <= 0.2


def test_op8_scores_are_those_of_the_plain_model(spark):
    """Each score by the words of the whole text, one feature after the other."""
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, Workspace(spark, "t"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert model.names
    for i, text in brute.rows_of(SF_CHECK, "documents", "doc_id", "text"):
        names = Counter(n for w in set((text or "").lower().split()) for n in toxicity.word_features(w))
        total = model.bias
        for name, places in model.names.items():
            total += sum(model.weights[p] for p in places[: names[name]] if p >= 0)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def checked_packing(pieces, rows, window=2048):
    """Pieces hold each row's ids once, fill sequences without gaps, and keep each queue in order."""
    coder = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc, text in rows:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc, np.array(ids, "<u4").tobytes()] += 1
    sequences, queues = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        queues[p.source].append(p)
    last = max(sequences, default=-1)
    assert sorted(sequences) == list(range(last + 1))
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window if s < last else at <= window
    # The pieces of a source, one after the other, are its rows one after the other.
    for queue in queues.values():
        queue.sort(key=lambda p: (p.sequence_id, p.offset))
        at = 0
        while at < len(queue):
            head, start, checks = queue[at], 0, []
            while start < head.doc_tokens:
                p = queue[at]
                assert (p.doc_id, p.start, p.doc_tokens) == (head.doc_id, start, head.doc_tokens)
                checks.append((start, p.length, p.ids_crc32))
                start, at = start + p.length, at + 1
            match = next(
                (
                    k
                    for k, n in want.items()
                    if n
                    and k[0] == head.doc_id
                    and len(k[1]) == 4 * head.doc_tokens
                    and all(zlib.crc32(k[1][4 * a : 4 * (a + b)]) == c for a, b, c in checks)
                ),
                None,
            )
            assert match, head
            want[match] -= 1
    assert not +want


def checked_mixture(pieces, window=2048):
    """Up to the end of every window each source has its share of all tokens, to within one."""
    total, held = Counter(), defaultdict(Counter)
    for p in pieces:
        total[p.source] += p.length
        held[p.sequence_id][p.source] += p.length
    whole, sent, done = sum(total.values()), Counter(), 0
    for s in sorted(held):
        sent += held[s]
        done += sum(held[s].values())
        assert all(abs(sent[x] - total[x] * done / whole) < 1 for x in total)
    return len(total)


def test_op9(spark, folder):
    pieces = QUERIES["op9_deficit_packing"](spark, folder).collect()
    checked_packing(pieces, brute.rows_of(folder, "documents", "doc_id", "text"))


def test_op9_mixture(spark):
    assert checked_mixture(QUERIES["op9_deficit_packing"](spark, SF_CHECK).collect()) == 20


def test_op10(spark, folder):
    got = QUERIES["op10_license_diagonals"](spark, folder).collect()
    want = [(i, *brute.license_base(t)) for i, t in brute.rows_of(folder, "documents", "doc_id", "text")]
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert plain(tuple(r[c] for c in columns) for r in got) == plain(want)
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(r.base_labels.split(",")) - {""} <= set(labels)
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


def test_op11(spark, folder):
    got = QUERIES["op11_merkle_manifest"](spark, folder).collect()
    want = brute.manifest(brute.rows_of(folder, "documents", "doc_id", "source", "lang", "n_chars", "text"))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert plain(tuple(r[c] for c in columns) for r in got) == plain(want)


def test_op12(spark, folder):
    got = QUERIES["op12_periodic_runs"](spark, folder).collect()
    # Trying every period is quadratic; the longest texts are left to the test of long texts.
    want = [brute.periodic(i, t) for i, t in brute.rows_of(folder, "documents", "doc_id", "text") if len(t or "") < 60_000]
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert not plain(want) - plain(tuple(r[c] for c in columns) for r in got)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in brute.rows_of(folder, "documents", "doc_id", "lang"))


def test_op13(spark, folder):
    got = QUERIES["op13_simhash_tiles"](spark, folder).collect()
    want = brute.print_groups(brute.rows_of(folder, "documents", "doc_id", "text"))
    assert plain((r.doc_id, r.fingerprint, r.component_id) for r in got) == plain(want)


def test_pipeline(spark, folder):
    """Each stage against plain Python on the rows that the stage before left."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    at = lambda df, *names: [tuple(r[n] for n in names) for r in df.collect()]
    (_, judge), (_, near), (_, scan), (_, mix), (_, pack) = corpus_pipeline.STAGES
    judged = judge(spark, docs, folder).cache()
    assert judged.columns == columns
    verdicts = [(r.doc_id, r.n_words, r.kept) for r in QUERIES["op6_risk_cutoffs"](spark, folder).collect()]
    assert plain(i for i in [(d,) for d, _, k in verdicts if k]) == plain(at(judged, "doc_id"))
    single = near(spark, judged, folder).cache()
    assert single.columns == columns
    # Each row is a document of its own here; of a group the smallest id stays, null last.
    rows = sorted(at(judged, "doc_id", "text"), key=lambda r: (r[0] is None, r[0] or 0))
    groups, _ = brute.near_groups([(i, t) for i, (_, t) in enumerate(rows)])
    assert Counter(i for (i,) in at(single, "doc_id")) == Counter(rows[i][0] for i in groups if groups[i] == i)
    masked = scan(spark, single, folder).cache()
    assert masked.columns == columns
    before = defaultdict(list)
    for i, text in at(single, "doc_id", "text"):
        before[i].append(text)
    for i, text in at(masked, "doc_id", "text"):
        if text not in before[i]:
            assert "[SECRET]" in text
            # What is left of the text stands in it as before, around the secrets.
            shape = re.compile(".+?".join(map(re.escape, text.split("[SECRET]"))), re.DOTALL)
            assert any(shape.fullmatch(b or "") for b in before[i])
        assert not re.search(r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)", text or "")
    mixed = mix(spark, masked, folder).cache()
    assert mixed.columns == columns
    masked_rows = at(masked, "doc_id", "source", "text")
    sizes = [(s, len(brute.WORD.findall(t or ""))) for _, s, t in masked_rows]
    _, target = brute.mix_targets(sizes)
    words = Counter()
    for _, s, t in at(mixed, "doc_id", "source", "text"):
        words[s] += len(brute.WORD.findall(t or ""))
    for s, t in target.items():
        assert abs(words[s] - t) <= 1
    whole = {(i, t) for i, _, t in masked_rows}
    assert sum((i, t) not in whole for i, _, t in at(mixed, "doc_id", "source", "text")) <= 2 * len(target)
    packed = pack(spark, mixed, folder)
    checked_packing(packed.collect(), at(mixed, "doc_id", "text"))


def test_the_order_of_the_mix_reaches_the_sequences(spark, tmp_path):
    """Over files of one stage to the next: a second pass is queued behind the whole first one."""
    names = ["few", "many", "some"]
    rows = [(i, f"d{i} " + "word " * 400, names[min(i % 7, 2)]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.repartition(5, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    op1 = {r.doc_id: r for r in QUERIES["op1_source_mix"](spark, str(tmp_path)).collect()}
    assert all((r.slot is not None) == (r.blocks > 0) == (r.taken > 0) for r in op1.values())
    assert len({r.slot for r in op1.values()}) > 30
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    mixed = corpus_pipeline.source_mix(spark, docs, str(tmp_path))
    order = [r.doc_id for r in mixed.collect()]
    firsts = list(dict.fromkeys(order))
    assert [op1[i].slot for i in firsts] == sorted(op1[i].slot for i in firsts)
    # Files of unlike sizes, which Spark reads in another order than they were written in.
    mixed.write.option("maxRecordsPerFile", 97).parquet(f"{tmp_path}/mixed")
    pieces = corpus_pipeline.pack_sequences(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    starts = sorted((r.sequence_id, r.offset, r.source, r.doc_id) for r in pieces if r.start == 0)
    twice = 0
    for s in names:
        queue = [i for _, _, x, i in starts if x == s]
        assert queue == [i for i in order if op1[i].source == s]
        of_source = sum(r.source == s for r in op1.values())
        assert len(set(queue[:of_source])) == min(of_source, len(queue))
        twice += len(queue) > of_source
    assert twice


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "pages"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_CHECK}/{table}.parquet'")
        cursor = db.execute(ORACLE[name])
        names = [c[0] for c in cursor.description]
        want = cursor.fetchall()
    got = QUERIES[name](spark, SF_CHECK)
    assert sorted(names) == sorted(got.columns)
    assert plain(got.select(*names).collect()) == plain(want)
