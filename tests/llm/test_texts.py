"""Toxicity, decontamination, token files, chat formatting: brute force, round trips, held-out accuracy, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tarmac import session
from tarmac.llm import chat, decontam, token_files, toxicity
from tarmac.llm.queries import TOKENIZER, op2_chat_formatting
from tarmac.llm.token_counts import encoded_counts
from tests.llm import brute, data

DOC = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "x" * 300_000), (5, "a b"), (5, "a b"), (None, "c d e f g"), (6, "w " * 50_000)]


# --- toxicity


def test_toxicity_on_documents_kept_out_of_training(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(toxicity.training_rows(docs, labels))
    scored = toxicity.score(docs.select("doc_id", "text"), model).filter(toxicity.held_out(F.col("doc_id")))
    rows = scored.join(labels, "doc_id").select("score", "toxic").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    hit = s >= toxicity.THRESHOLD
    recall, precision = (hit & (y == 1)).sum() / (y == 1).sum(), (hit & (y == 1)).sum() / hit.sum()
    order = np.argsort(np.argsort(s))
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    print(f"recall {recall:.3f} precision {precision:.3f} auc {auc:.3f}")
    # about 3,000 labelled rows; with 15,000 (check_s) 0.977, 0.848 and 0.995
    assert auc >= 0.92 and recall >= 0.68 and precision >= 0.7


def test_toxic_phrases_of_ordinary_words():
    """Toxic texts differ in the order of words only, so no word tells them."""

    def rows(n, seed):
        chosen = random.Random(seed)
        words = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu") for b in ("nd", "rt", "sk", "lm", "st", "rp", "th", "ng")]
        phrases = [" ".join(random.Random(100 + i).choices(words, k=6)) for i in range(20)]
        for i in range(n):
            text = [chosen.choice(words) for _ in range(chosen.randrange(80, 200))]
            for _ in range(0 if i % 6 else 4):
                text.insert(chosen.randrange(len(text)), chosen.choice(phrases))
            yield i, " ".join(text), int(i % 6 == 0)

    model = toxicity.train(list(rows(1500, 1)))
    count = toxicity.gain_counter(model)
    other = list(rows(600, 2))
    s, y = model.score(np.array([count(t) for _, t, _ in other])), np.array([y for *_, y in other])
    order = np.argsort(np.argsort(s))
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    hit = s >= toxicity.THRESHOLD
    # with words alone the area was below 0.7 and recall below 0.3
    assert auc >= 0.88 and (hit & (y == 1)).sum() >= 0.55 * (y == 1).sum()


def test_each_dictionary_is_trained_on_a_bounded_number_of_windows(monkeypatch):
    monkeypatch.setattr(toxicity, "TRAINING_WINDOWS", 7)
    sizes = []
    monkeypatch.setattr(toxicity, "_trained", lambda samples, size: sizes.append(len(samples)) or b" " * 8)
    toxicity.train([(i, " ".join(f"w{i}x{j}" for j in range(100)), i % 2) for i in range(30)])
    assert sizes == [7, 7]


def test_training_reads_no_held_out_row(spark):
    docs, labels = data.frame(spark, "documents"), data.frame(spark, "labels")
    used = {t for _, t, _ in toxicity.training_rows(docs, labels)}
    out = {t for i, t in data.rows("documents", "doc_id, text") if zlib.crc32(str(i).encode()) % 4 == 2}
    only_out = out - {t for i, t in data.rows("documents", "doc_id, text") if zlib.crc32(str(i).encode()) % 4 != 2}
    assert used and not used & only_out


def test_toxicity_of_odd_rows_and_tables(spark):
    docs = spark.createDataFrame(ODD, DOC)
    labels = data.frame(spark, "labels")
    model = toxicity.train(toxicity.training_rows(data.frame(spark, "documents"), labels))
    got = toxicity.score(data.clashing(docs).drop("score"), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    # without labels nothing is known
    none = toxicity.train(toxicity.training_rows(docs, labels.limit(0)))
    assert all(r.score < 0.01 for r in toxicity.score(docs, none).collect())
    assert toxicity.without_toxic(data.clashing(docs), labels).columns == data.clashing(docs).columns
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert b"".join(w.strip() for w in toxicity.windows("a " * 3000)).replace(b" ", b"") == b"a" * 3000


def plain_score(model, text):
    """The score from its definition, one window after another."""
    words = text.lower().split()
    runs = [" " + " ".join(words[i : i + 16]) + " " for i in range(0, len(words), 16)]
    pieces = [r.encode()[j : j + 512] for r in runs for j in range(0, len(r.encode()), 512)]

    def size(dictionary, piece):
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress(piece))

    gains, leads = [], []
    for piece in pieces:
        plain = size(model.ordinary, piece)
        gains.append(min(max(plain - size(model.words, piece), 0), 15))
        leads.append(min(max(plain - size(model.toxic, piece) + 8, 0), 31))
    n = len(pieces)
    known = sum(max(model.evidence[g], 0) for g in gains)
    lead = sum(x - 8 for x in leads)
    x = [math.log1p(known), known / max(n, 1), max(gains, default=0), math.log1p(n), lead / max(n, 1), max(leads, default=0)]
    z = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.mean, model.scale, strict=True))
    return 1 / (1 + math.exp(-max(min(z, 30), -30)))


def test_scores_equal_a_plain_computation(spark):
    docs, labels = data.frame(spark, "documents"), data.frame(spark, "labels")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    rows = data.rows("documents", "doc_id, text", "length(text) < 3000 ORDER BY doc_id LIMIT 40") + [(-1, ""), (-2, "x" * 2_000), (-3, "É ü " * 40)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, DOC), model).collect()}
    assert all(got[i] == pytest.approx(plain_score(model, t), rel=1e-9) for i, t in rows)


def test_training_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(4, "other")], DOC)
    labels = spark.createDataFrame([(1, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(t for _, t, _ in toxicity.training_rows(docs, labels)) == ["other", "text 0"]


def test_a_name_that_is_a_column_is_refused(spark):
    docs = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, Score string")
    with pytest.raises(ValueError, match="score"):
        toxicity.score(docs, toxicity.Model())
    with pytest.raises(ValueError, match="hits"):
        decontam.with_hits(docs.withColumnRenamed("Score", "HITS"), data.frame(spark, "benchmark"))


# --- decontamination


def plain_hits(docs, items):
    """Items of which enough five-word shingles occur in a text."""
    wanted = {i: brute.shingles(t) for i, t in items if i is not None and brute.words(t)}
    out = set()
    for d, text in docs:
        there = brute.shingles(text)
        out |= {(d, i) for i, s in wanted.items() if len(s & there) >= decontam.OVERLAP * len(s)}
    return out


def hits(spark, docs, items):
    got = decontam.with_hits(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string"))
    return [(r.doc_id, h.item_id) for r in got.collect() for h in r.hits]


def test_decontamination_equals_brute_force_on_a_table(spark):
    got = decontam.with_hits(data.clashing(data.frame(spark, "documents")), data.frame(spark, "benchmark"), name="found")
    found = {(r.doc_id, h.item_id) for r in got.select("doc_id", "found").collect() for h in r.found}
    assert found == plain_hits(data.rows("documents", "doc_id, text"), data.rows("benchmark", "item_id, text"))
    assert found


def test_decontamination_of_edited_and_long_items(spark, monkeypatch):
    random.seed(2)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n)) + ". " + " ".join(word() for _ in range(6)) + ".") for i, n in enumerate([5, 20, 31, 33, 64, 150, 400])]
    items += [(90, None), (None, "a b c d e"), (91, ""), (92, "yes no")]
    docs = []
    for i, text in items[:7]:
        w = text.split()
        edited = list(w)
        edited[len(w) // 2] = "changed"
        for k, body in enumerate((w, edited, w[: int(len(w) * 0.95)], w[: len(w) // 2])):
            noise = [" ".join(word() for _ in range(random.randrange(150))) for _ in range(2)]
            docs.append((10 * i + k, f"{noise[0]} {' '.join(body).upper()} {noise[1]}"))
    docs += [(900, "yes no"), (901, "oh yes no"), *ODD]
    want = plain_hits(docs, items)
    assert set(hits(spark, docs, items)) == want and (900, 92) in want and (901, 92) not in want
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 2)
    assert set(hits(spark, docs, items)) == want
    assert hits(spark, docs, []) == [] and hits(spark, [], items) == []


def test_decontamination_by_question_and_answer_apart(spark, monkeypatch):
    asked, said = "which of the seven old bridges carried the northern road?", "It was the stone bridge below the mill."
    short = "who built it? The guild of carpenters built it in one dry summer."
    items = [(1, f"{asked} {said}"), (2, short), (3, "who was first? Ann Lee was.")]
    far = " ".join(f"n{i}" for i in range(400))
    docs = [(1, f"{asked} answer {said}"), (2, f"{said} {far} {asked}"), (3, f"{far} {asked} {far}"), (4, f"{said} {far}")]
    docs += [(5, f"{short[14:]} {far} {short[:13]}"), (6, short[:13]), (7, short[14:]), (8, f"who was first? {far} Ann Lee was."), (9, "who was first? she was.")]
    want = {(1, 1), (2, 1), (3, 1), (5, 2), (8, 3)}
    assert not want & plain_hits(docs, items)
    assert sorted(hits(spark, docs, items)) == sorted(want)
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 1)
    assert sorted(hits(spark, docs, items)) == sorted(want)


def test_decontamination_by_items_of_few_words(spark):
    items = [(1, "Paris in May"), (2, "paris  in may"), (3, "to be or not"), (4, "yes no"), (5, "maybe"), (6, "one two three four five")]
    docs = [(1, "we saw PARIS in\nMay again"), (2, "Paris in"), (3, "to be or"), (4, "x to be or not to be or not"), (5, "oh yes no"), (6, "maybe"), (7, "maybe so")]
    want = {(1, 1), (1, 2), (4, 3), (6, 5)}
    assert sorted(hits(spark, docs, items)) == sorted(want) and set(hits(spark, docs, items[:5])) == want
    frames = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")
    every = {(r.doc_id, h.item_id) for r in decontam.with_hits(*frames, run_words=1).collect() for h in r.hits}
    assert every == want | {(5, 4), (7, 5)}
    kept = decontam.without_contaminated(*frames).collect()
    assert {r.doc_id for r in kept} == {2, 3, 5, 7}


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    docs, items = data.frame(spark, "documents"), data.frame(spark, "benchmark")
    near = spark.createDataFrame([(i, " ".join(t.split()[2:])) for i, t in data.rows("benchmark", "item_id, text")], DOC)
    docs = docs.select("doc_id", "text").unionByName(near)

    def scores():
        rows = decontam.with_hits(docs, items).selectExpr("doc_id", "inline(hits)").collect()
        return {(r.doc_id, r.item_id): r.bm25 for r in rows}

    want = scores()
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 20)
    assert want and scores() == pytest.approx(want, abs=1e-12)


def test_passages_above_the_threshold_are_all_retrieved():
    random.seed(4)
    words = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(random.choice(words) for _ in range(random.randrange(8, 30)))) for i in range(40)]
    index = decontam.build_index(items)
    texts = [" ".join(random.choice(words) for _ in range(random.randrange(1, 200))) for _ in range(30)] + [t for _, t in items]
    codes = {h: c for c, h in enumerate(index.vocabulary.tolist())}
    for _, bytes_, offsets in decontam.chunks(pa.array(texts)):
        hashes, first = decontam.word_hashes(bytes_, offsets)
        got = decontam._retrieve(index, hashes, first)
        for row in range(len(offsets) - 1):
            own = [codes.get(int(h)) for h in hashes[first[row] : first[row + 1]]]
            want: dict[int, float] = {}
            for at in range(0, max(1, len(own)), decontam.SEGMENT):
                asked = {c for c in own[at : at + decontam.SEGMENT * index.passage] if c is not None}
                for row_of, weights, of_part in index.blocks:
                    for p, score in enumerate(weights[[row_of[c] for c in asked]].sum(axis=0) if asked else []):
                        if score >= decontam.SCORE:
                            want[int(of_part[p])] = max(want.get(int(of_part[p]), 0), score)
            assert got.get(row, {}) == pytest.approx(want)


# --- token files


def encoded(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [token_files.END_ID] for _, t in rows]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    return [(rows[k][0], int(starts[k]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(ids)]


def written(spark, df, place):
    parts = token_files.write_token_files(df, place, public_tokenizers.path(TOKENIZER))
    return sorted((tuple(r) for r in token_files.read_token_files(spark, place, parts).collect()), key=lambda r: r[1])


def test_token_files_of_a_table(spark, tmp_path):
    rows = sorted(data.rows("documents", "doc_id, text"))
    assert written(spark, data.clashing(data.frame(spark, "documents")), f"file:{tmp_path}/t") == encoded(rows)


def test_parts_of_token_files_are_not_stored_as_a_table(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(session, "scratch_path", lambda _, label: kept.append(label) or f"{tmp_path}/{label}")
    assert len(written(spark, spark.createDataFrame(ODD, DOC), str(tmp_path / "t"))) == len(ODD)
    assert kept == []


def test_small_parts_are_read_back_by_few_tasks(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(100)], DOC)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = token_files.write_token_files(docs, str(tmp_path), public_tokenizers.path(TOKENIZER))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    cores, ids = spark.sparkContext.defaultParallelism, sum(n for _, _, n in parts)
    assert len(parts) > cores + 2
    for read_ids, tasks in ((token_files.READ_IDS, cores), (ids // (cores + 2), cores + 2), (1, len(parts))):
        monkeypatch.setattr(token_files, "READ_IDS", read_ids)
        back = token_files.read_token_files(spark, str(tmp_path), parts)
        assert back.rdd.getNumPartitions() == tasks
        assert sorted((tuple(r) for r in back.collect()), key=lambda r: r[1]) == encoded([(i, f"word {i}") for i in range(100)])


def test_token_files_of_odd_texts(spark, tmp_path):
    texts = ["Don't STOP, e.g. 3.14!", "a b c", "é é ǅ ﬀ ß İ", "<|endoftext|> x<|ENDOFTEXT|>y", "naïve,", "我们 12ab", "a\x0bb\x0cc\x1cd", "..,,", "o'clock's", "́a", "ÀÉ."]
    rows = [*ODD[:5], *[(10 + i, t) for i, t in enumerate(texts)]]
    ordered = sorted(rows, key=lambda r: r[0])
    assert written(spark, spark.createDataFrame(rows, DOC), str(tmp_path / "a")) == encoded(ordered)
    got = written(spark, spark.createDataFrame(ODD, DOC), str(tmp_path / "b"))
    assert [r[0] for r in got] == [None, 1, 2, 3, 4, 5, 5, 6] and got == encoded(sorted(ODD, key=lambda r: -1 if r[0] is None else r[0]))
    assert written(spark, spark.createDataFrame([], DOC), str(tmp_path / "c")) == []
    docs = spark.createDataFrame(rows, DOC).selectExpr("doc_id", "'s' source", "'l' lang", "text")
    counts = {r.doc_id: r.n_tokens + 1 for r in encoded_counts(docs, public_tokenizers.path(TOKENIZER), "bpe").collect()}
    assert counts == {r[0]: r[2] for r in encoded(ordered)}


# --- chat


TURN = "conv_id long, turn long, role string, text string"


def test_control_strings_come_back():
    texts = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user", "<\\|x", "<\\\\|", "<<SYS>> <</SYS>>", "<s", "[inst]", "", "é<|", "[[INST]]<<|"]
    escaped = chat.escape(pa.array(texts)).to_pylist()
    assert [chat.unescape(e) for e in escaped] == texts
    assert not any(re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", e) for e in escaped)


def test_chats_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "SLICE_BYTES", 40)
    rows = [(7, 2, "assistant", "<|im_end|>é"), (7, 1, "us\\er\n", "hi [INST]"), (7, 3, None, None), (7, 3, None, None)]
    rows += [(None, None, "assistant", "x" * 100_000), (None, 1, "user", "<|"), (9, 1, "assistant", ""), *[(8, i, "user", f"t{i}") for i in range(500)]]
    formatted = chat.format_chats(data.clashing(spark.createDataFrame(rows, TURN)))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    import hashlib

    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert set(got) == {7, 8, 9, None}
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], TURN))).count() == 0


def test_formatted_text_as_written(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b</s>")]
    r = chat.format_chats(spark.createDataFrame(rows, TURN)).collect()[0]
    assert r.formatted == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<\\/s><|im_end|>\n"
    assert r.formatted.encode()[r.loss_starts[0] : r.loss_ends[0]] == b"b<\\/s>"
    assert op2_chat_formatting(spark, data.SF).filter("conv_id = -1").collect()[0].loss_chars == 21


def test_words_that_are_forgotten_are_learnt_again(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_WORDS", 50)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 10)
    coder = token_files.WordEncoder(public_tokenizers.path(TOKENIZER))
    draw = random.Random(6)
    for _ in range(30):
        words = ["the", "of", "and", *("".join(draw.choice("abcdé") for _ in range(5)) + draw.choice(["", ".", "!?", "'s"]) for _ in range(30))]
        texts = [" ".join(draw.choices(words, k=40)) for _ in range(5)]
        ids, per_row = coder.encode(pa.array(texts))
        want = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for x in want for i in x] and per_row.tolist() == [len(x) for x in want]
        assert len(coder.slots) <= 50 + 200 and len(coder.uses) == len(coder.slots)
    coder.forget()
    assert {"the", "of", "and"} <= set(coder.slots) and len(coder.slots) == 10


def test_contexts_equal_a_plain_count():
    draw = random.Random(7)
    texts = ["", " ", "a", "a a a a", *(" ".join(draw.choices(["a", "b", "longword", "longworded", "é"], k=draw.randrange(12))) for _ in range(60))]
    seen = set()
    for text in texts:
        w = text.lower().split()
        seen |= {(w[i - 1] if i else "", w[i], w[i + 1] if i + 1 < len(w) else "") for i in range(len(w))}
    want = Counter(f"{x} " for _, x, _ in seen)
    for word, n in list(want.items()):
        for k in toxicity.PREFIXES:
            if len(word) > k + 1:
                want[word[:k]] += n
    assert toxicity._contexts(texts) == (want, len(seen)) and toxicity._contexts([]) == (Counter(), 0)
    toxicity.train([(i, "" if i % 5 == 0 else f"w{i} x", i % 2) for i in range(40)])
