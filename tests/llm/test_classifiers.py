"""Toxicity, quality and language: held-out accuracy on the test tables, method checks, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orefold.llm import language, quality, toxicity
from orefold.llm.common import remainder
from tests.llm.conftest import MIDDLE

EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "123 !!"), (5, "word"), (5, "word"), (None, "no id"), (6, "日本語")]


def tables(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet"), spark.read.parquet(f"{MIDDLE}/labels.parquet")


def area(scores, labels):
    """Share of (label 1, label 0) pairs in the right order."""
    scores, labels = np.array(scores), np.array(labels)
    ones, zeros = scores[labels == 1], scores[labels == 0]
    return ((ones[:, None] > zeros).mean() + (ones[:, None] == zeros).mean() / 2) if len(ones) and len(zeros) else 1.0


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    found = toxicity.classify(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert area([r["score"] for r in rows], [r["toxic"] for r in rows]) > 0.85
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.02 * len(rows)
    assert all((r["score"] >= 0.7) == r["predicted"] for r in rows)


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert area([r["score"] for r in rows], [r["quality"] for r in rows]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    assert all(r["predicted"] for r in rows if r["quality"])


def test_language_held_out(spark):
    docs, _ = tables(spark)
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_on_edge_rows(spark, documents, labels, long_text, module):
    docs = documents([*EDGES, (7, long_text)]).selectExpr("*", "1 AS score", "0 AS label", "'x' AS held_out")
    known = labels([(i, i % 2, i % 2) for i in range(1, 8)] + [(None, 1, 1), (5, None, None)])
    rows = module.classify(docs, known).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {None}
    assert module.classify(documents([]), known).count() == 0
    none = module.classify(docs, labels([])).collect()
    assert {r["predicted"] for r in none} == {0} and len(none) == 9
    assert len(module.classify(documents([(1, "a")]).drop("n_chars"), known).collect()) == 1


def test_labels_of_the_held_out_fold_are_never_learned(spark, documents, labels):
    rows = [(i, f"plain words here {i} " + ("vile " * (i % 2))) for i in range(400)]
    docs = documents(rows)
    fold = remainder("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    truth = labels([(i, 1, i % 2) for i in range(400)])
    lies = truth.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, truth).collect()}
    other = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, lies).collect()}
    assert one == pytest.approx(other)


def test_counterfactuals_take_the_weight_off_identity_terms():
    """A group mentioned mostly in toxic examples: with the penalty a neutral mention scores like that of another group."""
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslims" if toxic == (rng.random() < 0.9) else "christians"
        words = [f"w{k}" for k in rng.integers(0, 50, 8)] + [group] + (["vile"] if toxic and rng.random() < 0.8 else [])
        texts.append(" ".join(words))
        labels.append(toxic)
    owner, places = toxicity.word_features(pa.array(texts))
    rows = np.split(places, np.searchsorted(owner, np.arange(1, len(texts))))
    probes = pa.array(["the muslims celebrate", "the christians celebrate", "vile muslims", "w1 w2"])

    def scores(penalty):
        return toxicity.fit(rows, np.array(labels, float), toxicity.swaps(), penalty).score_column(probes)

    free, bound = scores(0.0), scores(toxicity.PENALTY)
    assert abs(free[0] - free[1]) > 0.3
    assert abs(bound[0] - bound[1]) < 0.1
    assert bound[2] > bound[0] and bound[2] > bound[3]


def test_factorisation_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    size = quality.WIDTH + quality.N_STATISTICS
    model = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)))
    places, table = np.array([5, 9, 5, 70]), rng.random((1, quality.N_STATISTICS))
    features = [(p, 1 / len(places)) for p in places] + [(quality.WIDTH + i, v) for i, v in enumerate(table[0])]
    expected = model.bias + sum(model.linear[p] * v for p, v in features)
    for i, (p, v) in enumerate(features):
        for q, w in features[i + 1 :]:
            expected += model.factors[p] @ model.factors[q] * v * w
    assert model.margin(np.zeros(4, int), places, table)[0] == pytest.approx(expected)


def test_statistics_of_a_text_match_plain_python(long_text):
    texts = ["", None, " \n ", "One two\ntwo | three!\n\nOne two", "# * $ % & < >", "日本語 ABC 123", "x\r\nx\n x", long_text]
    declared = np.array([0, -1, 5, 33, 13, 2, 100, len(long_text)])
    owner, places, table = quality.features(pa.array(texts), declared)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        words = raw.split()
        lines = [bytes(32 if 9 <= c <= 13 else c for c in line).rstrip() for line in raw.split(b"\n") if line]
        some, size, chars = max(len(words), 1), max(len(raw), 1), len(text or "")
        among = lambda marks: sum(raw.count(mark) for mark in marks.encode())
        expected = [
            min(among("#*$%&<>") / some / 3, 1), min(among("|") / some * 2, 1), min(among("!") / some / 2, 1),
            among("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size, among("0123456789") / size, min(len(raw) / some / 20, 1),
            (len(words) - len(set(words))) / some, (len(lines) - len(set(lines))) / max(len(lines), 1),
            min(len(lines) / some * 5, 1), min(np.log1p(len(words)) / 12, 1), float(not words),
            0 if declared[i] < 0 else min(abs(declared[i] - chars) / max(chars, 1), 1),
        ]
        assert table[i].tolist() == pytest.approx(expected)
        mine = places[owner == i].tolist()
        assert len(mine) == len(words) and len(set(mine)) <= len(set(words))
        assert len({(word, place) for word, place in zip(words, mine)}) == len(set(words))


def greedy_phrases(text: bytes, sample: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_cross_parsing_counts_greedy_phrases():
    rng = np.random.default_rng(5)
    sample = bytes(rng.integers(97, 101, 400, dtype=np.uint8))
    parser = language.Parser.of(sample)
    texts = [bytes(rng.integers(97, 103, n, dtype=np.uint8)) for n in (60, 31, 30, 7, 1)]
    lanes = np.zeros((60, 5), np.uint8)
    for i, text in enumerate(texts):
        lanes[: len(text), i] = list(text)
    found = parser.phrases(lanes, np.array([len(text) for text in texts]))
    assert found.tolist() == [greedy_phrases(text, sample) for text in texts]


def test_language_on_edge_rows(spark, documents, long_text):
    train = [(i, f"the house and the tree {i}", "en") for i in range(20, 40)]
    train += [(i, f"das haus und der baum {i}", "de") for i in range(40, 60)]
    train += [(60, "sin idioma", None), (61, None, "es"), (62, " ", "fr")]
    docs = documents([*EDGES, (7, long_text), *train]).selectExpr("*", "1 AS lang_pred", "2 AS found", "3 AS language")
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert by_id[6]["lang_pred"] in ("de", "en")
    assert by_id[25]["lang_pred"] == "en" and by_id[45]["lang_pred"] == "de"
    assert language.identify(documents([])).count() == 0
    assert {r["lang_pred"] for r in language.identify(documents([(1, "word", None)])).collect()} == {"und"}


def test_rejected_documents_go_and_columns_stay(spark, documents, labels):
    train = [(i, f"the house and the tree {i}", "en") for i in range(20, 60)]
    train += [(i, f"das haus und der baum {i}", "de") for i in range(60, 100)]
    docs = documents([(1, None), (2, "12"), *train]).selectExpr("*", "1 AS extra")
    left = language.accepted(docs)
    assert left.columns == docs.columns and left.count() == 80
    vile = documents([(i, "plain words" + " vile" * (i % 2)) for i in range(300)])
    left = toxicity.accepted(vile, labels([(i, 1, i % 2) for i in range(300)]))
    assert left.columns == vile.columns and sorted(r["doc_id"] for r in left.collect()) == list(range(0, 300, 2))


def test_the_language_stage_keeps_what_identify_gives_a_language(spark, documents):
    train = [(i, f"the house and the tree {i}", "en") for i in range(20, 60)]
    train += [(i, f"das haus und der baum {i}", "de") for i in range(60, 100)]
    group = [(i, "これは日本語の文章です", None) for i in range(200, 220)]
    docs = documents([*EDGES, (7, "q"), (8, "A.\nAll rights reserved."), *group, *train])
    known = sorted(r["doc_id"] or -1 for r in language.identify(docs).collect() if r["lang_pred"] != "und")
    assert {-1, 5, 6, 7, 8, *range(200, 220)} <= set(known) and not {1, 2, 3, 4} & set(known)
    assert sorted(r["doc_id"] or -1 for r in language.accepted(docs).collect()) == known
    one = documents([*EDGES, *train[:40]])
    assert language.accepted(one).count() == len([r for r in language.identify(one).collect() if r["lang_pred"] != "und"])


def held_out(spark, documents, rows):
    """Share of the held-out rows whose language is found, by language."""
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(documents(rows)).filter("held_out").collect()}
    right = {}
    for doc_id, _, lang in rows:
        if doc_id in found:
            right.setdefault(lang, []).append(found[doc_id] == lang)
    return {lang: sum(r) / len(r) for lang, r in right.items()}


@pytest.fixture(scope="module")
def prose(spark):
    """Texts of two languages of the test tables."""
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").filter("length(text) > 200").orderBy("doc_id").collect()
    return {lang: [r["text"] for r in rows if r["lang"] == lang] for lang in ("en", "de")}


def learning(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


def test_a_row_stored_a_thousand_times_counts_once(spark, documents, prose):
    rows = [(2 * i, t, "en") for i, t in enumerate(prose["en"][:60])] + [(2 * i + 1, t, "de") for i, t in enumerate(prose["de"][:60])]
    repeated = next(row for row in rows if row[2] == "de" and learning(row[0]))
    pieces = language.learned_pieces(documents([row for row in rows if learning(row[0])] + [repeated] * 1000))
    assert pieces == language.learned_pieces(documents([row for row in rows if learning(row[0])]))
    assert {len(found) for found in pieces.values()} == {language.LEARNED_PIECES}
    assert min(held_out(spark, documents, rows + [repeated] * 1000).values()) > 0.95


def test_a_language_with_300_bytes_is_found(spark, documents, prose):
    rows = [(2 * i, t, "en") for i, t in enumerate(prose["en"][:90])]
    known = next(i for i in range(1, 99, 2) if learning(i))
    rows.append((known, prose["de"][0][:280], "de"))
    rows += [(i, t, "de") for i, t in zip([i for i in range(1001, 2001, 2) if not learning(i)], prose["de"][1:60])]
    right = held_out(spark, documents, rows)
    assert right["de"] > 0.95 and right["en"] > 0.95


def test_a_stray_label_on_a_tiny_text_wins_nothing(spark, documents, prose):
    rows = [(2 * i, t, "en") for i, t in enumerate(prose["en"][:60])] + [(next(i for i in range(1, 99, 2) if learning(i)), "ok", "xx")]
    assert held_out(spark, documents, rows)["en"] == 1


def test_texts_with_a_long_opening_in_common(spark, documents, prose):
    opening = prose["en"][0][:200] * 10
    rows = [(2 * i, opening + t, "en") for i, t in enumerate(prose["en"][1:50])]
    rows += [(2 * i + 1, opening + t * 8, "de") for i, t in enumerate(prose["de"][1:50])]
    learned = language.learned_pieces(documents([row for row in rows if learning(row[0])]))
    shared = [sum(piece in opening for piece in found) for found in learned.values()]
    assert max(shared) <= len(opening) // language.LEARNED_CHARS + 1
    assert min(held_out(spark, documents, rows).values()) > 0.9


def test_the_choice_is_the_least_cost_of_a_plain_parse(spark, documents, prose):
    """Greedy phrases by plain search in the training text, their bits, and the least of them."""
    import math

    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, lang) for lang in prose for t in prose[lang][:25]])]
    model = language.learned(documents(rows))
    sources = [
        language.symbols(np.frombuffer(" ".join(found).encode(), np.uint8)).tobytes()
        for found in language.learned_pieces(documents([row for row in rows if learning(row[0])])).values()
    ]

    def cost(text, source):
        total = 0.0
        for low in range(0, len(text), language.PIECE):
            piece, at = text[low : low + language.PIECE], 0
            while at < len(piece):
                size = 1
                known = piece[at : at + 1] in source
                while known and at + size < len(piece) and piece[at : at + size + 1] in source:
                    size += 1
                bits = math.log2(len(source))
                total += bits if known else max(bits, language.LITERAL_BITS)
                at += size
        return total

    for row in language.identify(documents(rows), model).collect()[::7]:
        text = language.symbols(np.frombuffer(rows[row["doc_id"]][1].encode(), np.uint8)).tobytes()
        costs = [cost(text, source) for source in sources]
        assert row["lang_pred"] == model.languages[costs.index(min(costs))]


def test_conflicting_labels_and_rows_of_one_id_have_a_defined_choice(spark, documents, labels):
    from orefold.llm.common import labelled, one_per_id

    known = labels([(i, 0, 0) for i in range(20)] + [(i, 1, 1) for i in range(20)])
    sample = labelled(documents([(i, f"text {i}") for i in range(20)]), known, "toxic", 50, 3, 1)
    assert {r["label"] for r in sample.collect()} == {0}
    rows = spark.createDataFrame([(1, 1, [2]), (1, 0, [9]), (1, 0, [3, 1]), (2, 1, [])], "id long, label int, places array<int>")
    assert sorted(map(tuple, one_per_id(rows).collect())) == [(1, 0, [3, 1]), (2, 1, [])]


def test_toxicity_scores_match_a_plain_recomputation(spark):
    """Each distinct place of a text once, its weights added up in a loop, then the logistic function."""
    import math

    docs, labels = tables(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.classify(docs, labels, model).join(docs.select("doc_id", "text"), "doc_id").limit(60).collect()
    assert len({round(row["score"], 3) for row in rows}) > 5
    for row in rows:
        _, places = toxicity.word_features(pa.array([row["text"]]))
        margin = model.bias
        for place in sorted(set(places.tolist())):
            margin += float(model.weights[place])
        assert abs(1 / (1 + math.exp(-margin)) - row["score"]) < 1e-6
