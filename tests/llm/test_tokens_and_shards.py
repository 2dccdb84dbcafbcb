"""Piece ids against the public library, token counts against direct ones, shards and licenses against their rules."""

import random
import textwrap

import duckdb
import numpy as np
import pytest
import sentencepiece
import tiktoken

from lakemill.llm import license_join, piece_lattice as pl, queries, rendezvous, separator_scan as scan
from lakemill.llm.frames import Scratch
from lakemill.session import fresh_dir


@pytest.mark.parametrize("head", [pl.HEAD, 40])
def test_ids_equal_the_library_and_come_back(spark, docs_of, head):
    import public_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pl.PIECE_FILE))
    texts = ["Hello  world", " lead\n\ttab ", "a" * 300 + " " + "=-" * 90, "日本語🙂\x00 ß", "don't www.foo.com/x?y=1", "x", "same same same", "same same same", "", None]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    docs = docs_of(list(enumerate(texts)))
    out, p = pl.encoded(spark, docs, pl.load_pieces(), head)
    rows = out.select("text", f"{p}ids", f"{p}decoded").collect()
    assert len(rows) == len(texts)
    for text, ids, back in rows:
        assert ids == (None if text is None else model.encode(text)) and back == text
    again = pl.decoded(out.select("doc_id", "text", f"{p}ids"), pl.load_pieces(), f"{p}ids", "back")
    assert all(r.text == r.back for r in again.collect())


def best_path(word, scores):
    best = [(0.0, [])]
    for e in range(1, len(word) + 1):
        best.append(max(((best[s][0] + scores[word[s:e]], best[s][1] + [word[s:e]]) for s in range(e) if word[s:e] in scores), key=lambda x: x[0]))
    return best[-1][0]


def test_viterbi_takes_the_greatest_sum(spark):
    r = random.Random(1)
    vocab = sorted({"".join(r.choice("abc") for _ in range(r.randrange(1, 5))) for _ in range(60)} | set("abc"))
    table = pl.Pieces("unigram", [(w, i + 300, -r.random() * 10) for i, w in enumerate(vocab)], 0, 299)
    scores, names = {w: s for w, _, s in table.pieces}, {i: w for w, i, _ in table.pieces}
    segments = ["".join(r.choice("abc") for _ in range(r.randrange(1, 14))) for _ in range(60)] + ["aXb"]
    rows = spark.createDataFrame([(i, s, 1) for i, s in enumerate(segments)], "hash long, segment string, n long").repartition("hash", "segment")
    for i, ids in pl.encode_segments(rows, table).collect():
        if segments[i] == "aXb":
            assert ids == [next(k for k, w in names.items() if w == "a"), ord("X"), next(k for k, w in names.items() if w == "b")]
        else:
            path = [names[k] for k in ids]
            assert "".join(path) == segments[i] and abs(sum(scores[w] for w in path) - best_path(segments[i], scores)) < 1e-9


def test_separators_in_flat_files_across_blocks(spark, tmp_path):
    r = np.random.default_rng(0)
    want = []
    for f in range(3):
        tokens = r.integers(0, 9, 3000).astype("<u2")
        tokens[500:1500] = 3
        tokens.tofile(tmp_path / f"{f}.bin")
        start = 0
        for o, e in enumerate(np.flatnonzero(tokens == 7)):
            want.append((f"{f}.bin", o, start, int(e) - start, True))
            start = int(e) + 1
        if start < len(tokens):
            want.append((f"{f}.bin", o + 1, start, len(tokens) - start, False))
    blocks = scan.flat_blocks(spark, str(tmp_path), 2, 64)
    got = [(r.stream.rsplit("/", 1)[1], r.ordinal, r.start, r.n_tokens, r.finished) for r in scan.document_lengths(Scratch(spark), blocks, separator=7).collect()]
    assert sorted(got) == sorted(want)


def test_counts_from_streams_equal_direct_counts(spark):
    ranks, pattern = scan._ranks(None)
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op1_separator_scan(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in texts.items()}


def test_shards_follow_weights_and_move_little(spark):
    records = spark.range(4000).selectExpr("id AS doc_id", "id % 7 AS size").unionAll(spark.createDataFrame([(1, 1)] * 9000, "doc_id long, size long"))
    rows = rendezvous.sharded(records, "doc_id", [1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 1.0]).collect()
    assert len(rows) == 13000
    for shard in range(3):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    ids = {r.doc_id: r for r in rows}.values()
    assert abs(sum(r.shard == 1 for r in ids) / 4000 - 0.5) < 0.04 and abs(sum(r.grown_shard == 3 for r in ids) / 4000 - 0.2) < 0.03


def test_license_blocks_and_phrases(spark, docs_of):
    pairs = [
        (1, "x\nReleased under the MIT License.\ny"), (2, "All rights reserved. CC BY CC BY 4.0"), (3, "the license of the"),
        (4, "Licensed by the Apache License version 2.0 maybe"), (5, None), (6, "released under MIT")]
    rows = {r.doc_id: r for r in license_join.scanned(spark, docs_of(pairs)).collect()}
    assert (rows[1].labels, rows[1].base_labels, rows[1].n_base) == ("mit", "", 0) and rows[1].score == 1.0
    assert (rows[2].base_labels, rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].n_words) == ("cc-by,reserved", 3, 0, 5, 9)
    assert rows[3].labels == "" and rows[3].score == 0.0 and rows[4].labels == "apache-2.0" and rows[4].score == 7 / 8
    assert rows[5].n_words == 0 and rows[5].first_word is None and rows[6].labels == ""


def test_a_text_is_split_once_for_its_blocks(spark, docs_of):
    """Not again for every template word it holds: the optimizer must not put the split where it is used."""
    plan = license_join.block_matches(spark, docs_of([(1, "Released under the MIT License")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lowered") == 1


def licenses(spark, docs_of, texts):
    return [tuple(r[:2]) for r in license_join.scanned(spark, docs_of(list(enumerate(texts)))).orderBy("doc_id").select("labels", "score").collect()]


def wrapped(text, columns, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, columns))


def test_wrapped_notices(spark, docs_of):
    notices = [(label, text) for label, text in license_join.TEMPLATES]
    texts = [f"x y\n{wrapped(text, columns, mark)}\nz" for _, text in notices for columns, mark in ((72, ""), (40, "# "), (24, " * "))]
    for (labels, score), (label, _) in zip(licenses(spark, docs_of, texts), [n for n in notices for _ in range(3)], strict=True):
        assert set(labels.split(",")) - {"cc-by", "gpl"} == {label} and score == 1.0


def test_the_word_that_names_the_license_counts(spark, docs_of):
    texts = ["Licensed under CC BY-NC 4.0", "Licensed under CC BY-SA 4.0", "Licensed under CC BY 4.0", "Released under the BSD License",
             "This work is licensed under the GNU General Public License, version 2", "Released under the MIT License",
             " ".join(["released"] + ["a"] * 40 + ["under"] + ["b"] * 40 + ["the mit"] + ["c"] * 40 + ["license"])]
    assert [found for found, _ in licenses(spark, docs_of, texts)] == ["cc-by,cc-by-nc", "cc-by,cc-by-sa", "cc-by", "", "gpl", "mit", ""]


def test_blocks_equal_sql(spark, docs_of):
    r = random.Random(8)
    texts = []
    for _ in range(80):
        words = [w for _, text in r.sample(license_join.TEMPLATES, 2) for w in text.split() if r.random() < 0.93]
        texts.append("".join(w + r.choice((" ", " ", " ", "\n", " und ")) for w in words))
    rows = ", ".join(
        f"({t}, '{label}', {sorted(set(w))}, {list(license_join.TELLING[t])}::VARCHAR[], {-(-len(w) * 5 // 4)})"
        for t, (label, text) in enumerate(license_join.TEMPLATES) for w in [license_join.template_words(text)])
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", list(enumerate(texts)))
    want = con.execute(f"""WITH templates(template, label, words, telling, span) AS (VALUES {rows}),
        w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM docs),
        blocks AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w),
        met AS (SELECT doc_id, template, len(list_distinct(list_intersect(words, list_slice(w, i, i + span - 1)))) AS n, len(words) AS size,
          list_has_all(list_slice(w, i, i + span - 1), telling) AS named FROM blocks, templates)
        SELECT doc_id, template, max(n / size) FROM met WHERE named AND n >= 0.8 * size - 1e-9 GROUP BY ALL ORDER BY ALL""").fetchall()
    got = license_join.block_matches(spark, docs_of(list(enumerate(texts)))).select("doc_id", "template", "containment").orderBy("doc_id", "template").collect()
    assert len(want) > 60 and [tuple(x) for x in got] == want
