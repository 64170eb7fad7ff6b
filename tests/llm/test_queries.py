"""The registered queries and the pipeline over small tables, against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpora import prose
from test_near import classes, edited
from test_quality import brute
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(120):
        lang = ["en", "fr", "de"][i % 3]
        extra = {"en": " the and of ", "fr": " le la été ", "de": " der und über "}[lang]
        text = extra * 6 + prose(i, rng.choice([12, 60, 150, 400]))
        out.append((text, lang, rng.choice(["s0"] * 4 + ["s1", "s2", None])))
    base = prose(700, 150)
    out += [(edited(base, rng, 1), "en", "s0") for _ in range(12)]
    passage = prose(800, 60)
    out += [(prose(900 + k, 80) + " " + passage, "de", "s1") for k in range(3)]
    out += [("the same text again " * 3, "en", "s0")] * 15 + [("", "en", "s1"), (None, None, None), ("!!! 123", "en", "s2")]
    bad = [(t + " horridword vileword", "en", "s1") for t, _, _ in out[:60:2]]
    rng.shuffle(out)
    return [(i, t, lang, s, len(t or "")) for i, (t, lang, s) in enumerate(out + bad)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{top}/documents.parquet")
    labels = [(i, int(len((t or "").split()) > 20), int("vileword" in (t or ""))) for i, t, *_ in rows if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    turns = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t} <#\\>") for c in range(20) for t in range(1 + c % 5)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{top}/conversations.parquet")
    return top


@pytest.fixture(scope="module")
def answer(spark, folder):
    queries = __spark_entry__.queries()

    def run(name):
        return queries[name](spark, folder).collect()

    return run


def held(i, folds, at):
    return zlib.crc32(str(i).encode()) % folds == at


def test_every_operator_has_one_query():
    names = [q for q in __spark_entry__.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_toxicity(answer, rows):
    out = {r.doc_id: r for r in answer("op1_toxicity")}
    assert set(out) == {r[0] for r in rows}
    assert all(r.held_out == held(i, 3, 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for i, r in out.items())
    right = [out[i].predicted == ("vileword" in (t or "")) for i, t, *_ in rows if out[i].held_out]
    assert np.mean(right) > 0.9


def test_mixing(answer, rows):
    out = {r.doc_id: r for r in answer("op3_mixing")}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, _, s, _ in rows:
        assert out[i]["size"] == len((t or "").encode().split()) and out[i].taken <= 3 * out[i]["size"]
        sizes[s] += out[i]["size"]
        taken[s] += out[i].taken
    for i, _, _, s, _ in rows:
        assert out[i].source_size == sizes[s] and abs(taken[s] - out[i].target) <= max(3, 0.01 * out[i].target)


def test_quality(answer, rows):
    out = {r.doc_id: r for r in answer("op4_quality")}
    for i, t, *_ in rows:
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)


def pieces_are_whole(found, texts):
    """Every document's ids lie in its pieces, and every sequence is gapless."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by, filled = defaultdict(list), defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        copies = len(by[i]) and sum(r.length for r in by[i]) // len(ids)
        assert sum(r.length for r in by[i]) == copies * len(ids)
        times = Counter()
        for r in by[i]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            times.update(range(r.start, r.start + r.length))
        assert set(times.values()) <= {copies}
    for own in filled.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(n for _, n in own) <= 2048
    return by


def test_packing(answer, rows):
    by = pieces_are_whole(answer("op5_packing"), {r[0]: r[1] for r in rows})
    assert set(by) == {r[0] for r in rows}


def test_near_duplicates(answer, rows):
    out = defaultdict(list)
    for r in answer("op6_near_dedup"):
        out[r.class_id].append(r.doc_id)
    assert sorted(sorted(x) for x in out.values()) == classes([r[:2] for r in rows])


def test_passages(answer, rows):
    out = {r.doc_id: r for r in answer("op2_substring_dedup")}
    assert set(out) == {r[0] for r in rows}
    sharing = [i for i, t, *_ in rows if t and prose(800, 60) in t]
    assert len(sharing) == 3 and len({out[i].class_id for i in sharing}) == 1 and all(out[i].n_links for i in sharing)


def test_language(answer, rows):
    out = {r.doc_id: r for r in answer("op9_language_id")}
    for i, t, lang, *_ in rows:
        assert out[i].held_out == held(i, 5, 0)
        if t and any(c.isalpha() for c in t):
            assert out[i].lang_pred in ("en", "fr", "de")
        else:
            assert out[i].lang_pred == "und"


def test_token_counts_and_exact_groups(answer, rows):
    assert {r.doc_id for r in answer("op10_token_counts")} == {r[0] for r in rows}
    copies = Counter(t or "" for _, t, *_ in rows)
    texts = {i: t or "" for i, t, *_ in rows}
    for r in answer("op7_exact_dedup"):
        assert r.group_size == copies[texts[r.doc_id]] and texts[r.keep_id] == texts[r.doc_id] and r.kept == (r.doc_id == r.keep_id)


def test_pipeline_stages(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = {r[0]: r[1] for r in rows}
    told = corpus_pipeline.language(spark, docs, folder)
    assert told.columns == columns
    kept = {r.doc_id: r.text for r in told.collect()}
    assert set(kept) == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    exact = corpus_pipeline.exact_copies(spark, told, folder)
    assert sorted(r.text for r in exact.collect()) == sorted(set(kept.values()))
    near = corpus_pipeline.near_copies(spark, exact, folder)
    left = {r.doc_id for r in near.collect()}
    assert left == {c[0] for c in classes([(r.doc_id, r.text) for r in exact.collect()])}
    mixed = corpus_pipeline.mix(spark, near, folder)
    assert mixed.columns == columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    again = corpus_pipeline.mix(spark, near, folder)
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in again.collect())
    found = corpus_pipeline.pack(spark, mixed, folder).collect()
    by = pieces_are_whole(found, {r.doc_id: r.text for r in mixed.collect()})
    copies = Counter(r.doc_id for r in mixed.collect())
    assert {i: sum(r.length for r in own) // own[0].doc_tokens for i, own in by.items()} == dict(copies)


def test_pipeline_run_is_its_stages(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_copies", "near_copies", "mix", "pack"]
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    top = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    assert corpus_pipeline.run(spark, top).collect() == []


def test_encoding(answer, rows):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = {r.doc_id: r for r in answer("op11_sentencepiece")}
    assert len(out) == len(rows)
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_eos=True)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids)))
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(ids), *digests)


def test_periodic_runs(answer, rows):
    import hashlib

    from test_runs import brute as every_run

    out = {r.doc_id: r for r in answer("op12_periodic_runs")}
    assert len(out) == len(rows)
    for i, t, *_ in rows:
        words, h = [w.decode() for w in (t or "").encode().split()], zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = [(s, e - s, q) for s, q, e in every_run(words)]
        kept = [not any(s + q <= k < s + n for s, n, q in found) for k in range(len(words))]
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        texts = "".join(f"{s},{n},{q}\n" for s, n, q in found), " ".join(w for w, k in zip(words, kept, strict=True) if k)
        r = out[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *told)
        assert (r.runs_sha256, r.collapsed_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in texts)


def test_prefix_trie(answer):
    from test_prefix_trie import brute as nodes

    own = {c: [(["user", "assistant"][t % 2], f"text {c} {t} <#\\>") for t in range(1 + c % 5)] for c in range(20)}
    rebuilt = {c: own[c - c % 5][: (h := zlib.crc32(str(c).encode()) % 9)] + own[c][h:] for c in own}
    assert sorted((tuple(r) for r in answer("op13_prefix_trie")), key=str) == nodes(rebuilt)
