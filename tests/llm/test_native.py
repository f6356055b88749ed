"""Mixing, licenses, lines and token counts: the queries against SQL, and odd rows."""

from collections import Counter

import pytest

import corpus_pipeline
from tarmac.llm import decontam, licenses, line_dedup, mixing, token_counts, toxicity
from tarmac.llm.frames import table
from tarmac.llm.oracle import ORACLE
from tarmac.llm.queries import QUERIES
from tarmac.session import scratch_path
from tests.compare import compare, connect
from tests.llm import brute, data

DOC = "doc_id long, text string, source string"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, data.SF), ORACLE[name], connect(data.SF))["problems"] == []


def mixed(spark, rows, **options):
    return mixing.mix(data.clashing(spark.createDataFrame(rows, DOC)), **options).collect()


def test_sources_meet_their_targets(spark):
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 3 + [None] * 20)]
    got = mixed(spark, rows)
    total = sum(r.size for r in got)
    assert sum(r.taken for r in got) == pytest.approx(total, abs=4)
    for source in ("a", "b", "c", None):
        own = [r for r in got if r.source == source]
        assert sum(r.taken for r in own) == round(own[0].target) and own[0].source_size == sum(r.size for r in own)
        assert all(r.taken <= 3 * r.size for r in own) and own[0].target <= 3 * own[0].source_size
        # complete epochs come first
        epochs = round(own[0].target) // own[0].source_size
        assert all(epochs * r.size <= r.taken <= (epochs + 1) * r.size for r in own)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixed(spark, list(reversed(rows)))), key=str)


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "w " * 20_000, "b"), (4, "u v", "b"), (4, "u v", "b")]
    got = mixed(spark, rows)
    assert sorted(r.size for r in got) == [0, 0, 2, 2, 2, 2, 20_000] and mixed(spark, []) == []
    assert all(r.taken == 0 for r in mixed(spark, [(1, None, None), (2, " ", "z")]))
    docs = data.clashing(spark.createDataFrame(rows, DOC))
    taken = mixing.mixed_documents(docs)
    assert taken.columns == docs.columns
    times = Counter(r.doc_id for r in taken.collect())
    want = {r.doc_id: r.taken // r.size for r in mixed(spark, rows, whole=True) if r.size and r.doc_id == 3}
    assert times[3] == want[3]


def test_lines_as_written(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny\nb\nc\nd"), (3, "a\nb"), (4, None), (5, ""), (6, "\n\n\n\n"), (7, "\n\n\n\n"), (None, "q\nr\ns\nt"), (8, "q\nr\ns\nt"), (8, "q\nr\ns\nt")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text, r.n_removed) for r in line_dedup.drop_repeated_lines(data.clashing(frame)).collect()), key=str)
    want = [(1, "a\nb\nc\nd", 0), (2, "x\ny", 6), (3, "a\nb", 0), (4, None, 0), (5, "", 0), (6, "\n\n\n\n", 0), (7, "\n\n\n\n", 0), (0, "q\nr\ns\nt", 0), (8, "", 4), (8, "", 4)]
    assert got == sorted(want, key=str)
    assert line_dedup.drop_repeated_lines(frame.limit(0)).count() == 0


def test_the_first_occurrence_of_lines_stays_whole(spark):
    rows = [(1, "a\na\na\na"), (2, "a\na\na"), (3, "b\nb\nb\nb\nb\nb\nb"), (4, "c\nd\nc\nd\nc"), (5, "x\nd\nc\nd")]
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "a\na\na\na", 2: "", 3: "b\nb\nb", 4: "c\nd\nc\nd\nc", 5: "x"}


def test_licenses_in_other_spellings(spark):
    mit = licenses._MIT
    rows = [(1, "Copyright (c) 2020 X\n" + mit.upper().replace(",", " ;")), (2, "text\nreleased under the MIT licence\nmore"), (3, None), (4, ""), (5, "..."), (2, "Licensed under CC BY NC 4.0"), (None, "SPDX-License-Identifier: MIT"), (6, "no license here " * 9_000)]
    got = [(r.doc_id, r.whole_license, r.line_licenses) for r in licenses.scan_licenses(data.clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()]
    want = [(1, "MIT", []), (2, None, ["CC-BY-NC-4.0", "MIT"]), (3, None, []), (4, None, []), (5, None, []), (2, "CC-BY-NC-4.0", ["CC-BY-NC-4.0", "MIT"]), (None, "MIT", ["MIT"]), (6, None, [])]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def wrapped(text, width, mark=""):
    words, lines, line = text.split(), [], ""
    for word in words:
        if line and len(line) + len(word) >= width:
            lines, line = [*lines, mark + line], ""
        line = f"{line} {word}" if line else word
    return "\n".join([*lines, mark + line])


def test_whole_licenses(spark):
    """However lines are broken, with comment marks, headings and notices of all kinds."""
    bsd = [licenses._BSD_SOURCE, licenses._BSD_BINARY, licenses._BSD_NAME]
    texts = {
        1: ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2019 Some One\nCopyright 2020, Others\n\n" + wrapped(licenses._MIT, 60)),
        2: ("MIT", "// Copyright: nobody\n//\n" + wrapped(licenses._MIT, 40, "// ")),
        3: ("MIT", wrapped(licenses._MIT, 10_000)),
        4: ("ISC", "/*\n * ISC License\n *\n * (c) 2001 x@example.com\n" + wrapped(licenses._ISC, 72, " * ") + "\n */"),
        5: ("BSD-2-Clause", "# © 1999 X\n# All rights reserved.\n" + wrapped(licenses._bsd(bsd[:2], True), 75, "# ")),
        6: ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright by X\n\n" + wrapped(licenses._bsd(bsd, False), 64)),
        7: (None, licenses._MIT + "\nand more"),
        8: (None, licenses._MIT.replace("without restriction", "")),
    }
    rows = [(i, text) for i, (_, text) in texts.items()]
    got = {r.doc_id: r.whole_license for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: name for i, (name, _) in texts.items()}


def test_lines_in_equivalent_spellings(spark):
    lines = ["  * Licenced under the MIT Licence!", "LICENSED under the mit license", "x Licensed under the MIT License", "© Licensed under the MIT License", "merchantibility of X", "Merchantability of x"]
    known = [("MIT", "Licensed under the MIT License."), ("X", "Merchantability of X")]
    got = licenses.scan_licenses(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), known=known).collect()
    assert {r.doc_id: r.line_licenses for r in got} == {0: ["MIT"], 1: ["MIT"], 2: [], 3: [], 4: ["X"], 5: ["X"]}


def test_token_counts_follow_changes_and_count_batches_once(spark):
    schema = "doc_id long, source string, lang string, version string, n_tokens long, op string, order int"
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))

    def commit(name, *rows):
        return rollup.commit(name, spark.createDataFrame(rows, schema))

    def totals():
        return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}

    assert totals() == {}
    first = [(1, "a", "en", "v1", 10, "upsert", 0), (2, "a", None, "v1", None, "upsert", 0), (None, "a", "en", None, 5, "upsert", 0)]
    assert commit("one", *first, first[0]) and not commit("one", *first)
    assert totals() == {("a", "en", "v1"): (1, 10), ("a", None, "v1"): (1, 0), ("a", "en", None): (1, 5)}
    # a revision that moves the document, a delete of an unknown one, several rows for a key
    commit("two", (1, "b", "en", "v1", 7, "upsert", 0), (9, "a", "en", "v1", 3, "delete", 0), (2, "a", None, "v1", 4, "delete", 1), (2, "a", None, "v1", 8, "upsert", 2))
    assert totals() == {("b", "en", "v1"): (1, 7), ("a", None, "v1"): (1, 8), ("a", "en", None): (1, 5)}
    assert commit("empty") and commit("three", (1, None, None, "v1", None, "delete", 0), (None, "a", "en", None, 5, "delete", 0))
    assert totals() == {("a", None, "v1"): (1, 8), ("a", "en", None): (1, 5)}


def test_pipeline_against_its_parts(spark):
    """Each stage on what the one before kept, recomputed plainly from the same scores and targets."""
    docs = data.rows("documents", "doc_id, text, source")
    model = toxicity.train(toxicity.training_rows(data.frame(spark, "documents"), data.frame(spark, "labels")))
    scores = {r.doc_id: r.score for r in toxicity.score(data.frame(spark, "documents"), model).collect()}
    docs = [r for r in docs if scores[r[0]] < toxicity.THRESHOLD]
    groups = brute.near_duplicates([r[:2] for r in docs])
    docs = [r for r in docs if groups[r[0]][1] == r[0]]
    items = [brute.shingles(t) for _, t in data.rows("benchmark", "item_id, text")]
    docs = [r for r in docs if not any(len(s & brute.shingles(r[1])) >= decontam.OVERLAP * len(s) for s in items)]
    plan = mixing.mix(spark.createDataFrame(docs, DOC), whole=True).collect()
    want = Counter({r.doc_id: r.taken // r.size for r in plan if r.size and r.taken})
    got = corpus_pipeline.run(spark, data.SF).collect()
    assert Counter(r.doc_id for r in got) == want
    starts = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert [s for s, _, _ in starts] == [sum(n for _, n, _ in starts[:k]) for k in range(len(starts))]
    assert [d for _, _, d in starts] == sorted(d for _, _, d in starts)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]
    first = corpus_pipeline.STAGES[0][1](spark, table(spark, data.SF, "documents"), data.SF)
    assert first.columns == data.frame(spark, "documents").columns
