"""Near duplicates, repeated passages, fingerprints and packing against plain Python; edge rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orefold.llm import components, fingerprint, minhash, packing, queries, repeats, textgrid
from tests.llm.conftest import SMALL


def texts_of(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


# Near duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def linked(rows):
    """Component by brute force over all pairs."""
    sets = {i: shingles(text) for i, text in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if sets[i] and sets[j] and 4 * min(len(sets[i]), len(sets[j])) >= 3 * max(len(sets[i]), len(sets[j])):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def check_near(df, rows):
    expected = linked(rows)
    found = {r["doc_id"]: r for r in df.collect()}
    assert len(found) == len(expected)
    for i, (size, component) in expected.items():
        row = found[i]
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (size, component, i == component)


def test_near_duplicates_match_brute_force(spark):
    check_near(queries.QUERIES["op2_minhash_dedup"](spark, SMALL), texts_of(spark))


def varied(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_chains_and_groups_of_near_copies(spark, documents):
    """Copies that are near each other only by a chain of links, a large group, and two groups that share half their text."""
    rng = random.Random(4)
    rows, n = [], 0
    chain = [f"c{i}" for i in range(200)]
    for step in range(8):
        rows.append((1000 - step, " ".join(chain)))
        chain = chain[:] if step % 2 else [*chain[12:], *[f"d{step}_{i}" for i in range(12)]]
    base = [f"b{i}" for i in range(150)]
    for n in range(60):
        rows.append((n, varied(rng, base, rng.choice([1, 2, 4, 5]))))
    other = [*base[:75], *[f"o{i}" for i in range(75)]]
    for n in range(60, 90):
        rows.append((n, varied(rng, other, 2)))
    check_near(minhash.near_duplicates(documents(rows)), rows)


def test_blocks_of_long_texts_are_bounded_by_their_bytes(spark, documents, monkeypatch):
    """The members of a bucket dealt out: every pair that has to be compared meets in one block, and blocks stay small."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 400_000)
    members = [(i, 20_000 + 1000 * (i % 7), 7 if i % 3 else i) for i in range(90)]
    total, other = (sum(m[1] for m in members if keep(m)) for keep in (lambda m: True, lambda m: m[2] != 7))
    outside = sum(m[2] != 7 for m in members)
    rows = [(1, 0, i, size, component, 7, 90, outside, total, other) for i, size, component in members]
    names = "band long, place int, id long, n_bytes long, component long, main long, `all` long, others long, "
    dealt = minhash._dealt(spark.createDataFrame(rows, names + "all_bytes long, other_bytes long")).collect()
    blocks = defaultdict(lambda: ([], []))
    for r in dealt:
        blocks[r["p"], r["q"]][r["asks"]].append((r["id"], r["n_bytes"]))
    assert max(sum(size for _, size in side) for pair in blocks.values() for side in pair) < 2 * minhash.BLOCK_BYTES
    met = [(a, b) for answers, asks in blocks.values() for a, _ in asks for b, _ in answers]
    assert sorted(met) == sorted((a, b) for a, _, c in members if c != 7 for b, *_ in members)
    huge = [(1, 0, i, 10**10, i, 0, 3, 2, 3 * 10**10, 2 * 10**10) for i in range(3)]
    dealt = minhash._dealt(spark.createDataFrame(huge, names + "all_bytes long, other_bytes long"))
    assert dealt.selectExpr("max(p)", "max(q)").first()[0] <= 1 and dealt.count() <= 2 * 3 + 3 * 2


def test_small_blocks_lose_no_link(spark, documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 2000)
    test_chains_and_groups_of_near_copies(spark, documents)


def made_block(seed):
    """Members of one bucket: families of near copies and strangers, in random components, some of them asking."""
    rng = random.Random(seed)
    texts = []
    for _ in range(20):
        words = [f"w{rng.randrange(50_000)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(rng.randrange(1, 5)):
            copy = words[:]
            for at in rng.sample(range(len(copy)), rng.randrange(len(copy) // 25 + 1)):
                copy[at] = f"n{rng.randrange(50_000)}"
            texts.append(" ".join(copy))
    column, place = pa.array(texts), seed % 4
    component = [rng.randrange(6) for _ in texts]
    sizes, _, _, bands, sketch = minhash.signatures(*minhash.shingle_sets(column), len(texts))
    rows = [
        (1, place, 0, 0, asks, i, component[i], 0, int(sizes[i]), bands[i, :place].view(np.int64).tolist(), sketch[i].tobytes())
        for i in range(len(texts))
        for asks in (False, True)
    ]
    types = (
        [pa.int64()] + [pa.int32()] * 3 + [pa.bool_()] + [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
    )
    names = ("band", "place", "p", "q", "asks", "id", "component", "main", "n", "bands", "sketch")
    block = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))
    return block, column


def with_texts(block, column):
    return block.append_column("text", column.take(block["id"].combine_chunks()))


@pytest.mark.parametrize("seed", range(8))
def test_signatures_choose_the_members_whose_texts_are_compared(seed):
    block, column = made_block(seed)
    place = block["place"][0].as_py()
    chosen = minhash.with_partners(block)
    assert 0 < len(chosen) < len(block)
    links = minhash.compare_block(with_texts(block, column))
    assert minhash.compare_block(with_texts(chosen, column)) == links
    sets = [shingles(text) for text in column.to_pylist()]
    rows = {row["id"]: row for row in block.to_pylist()}
    expected = set()
    for a, one in rows.items():
        for b, other in rows.items():
            apart = one["component"] != other["component"] and (other["component"] == 0 or b > a)
            met = any(x == y for x, y in zip(one["bands"], other["bands"]))
            if apart and not met and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                expected.add((a, other["component"]))
    found = links.to_pylist()
    assert sorted((link["a"], rows[link["b"]]["component"]) for link in found) == sorted(expected)
    assert all(100 * len(sets[x["a"]] & sets[x["b"]]) >= 75 * len(sets[x["a"]] | sets[x["b"]]) for x in found)
    assert expected or place


def test_strangers_in_a_bucket_need_no_texts():
    block, column = made_block(1)
    one_each = {words.split()[0]: i for i, words in enumerate(column.to_pylist())}.values()
    strangers = [i for i in one_each if all(len(shingles(column[i].as_py()) & shingles(column[j].as_py())) == 0 for j in one_each if j != i)]
    assert len(strangers) > 5
    assert len(minhash.with_partners(block.filter(pa.array([i in strangers for i in block["id"].to_pylist()])))) == 0


def test_pairs_of_similarity_75_to_80_share_a_bucket():
    """Recall of banding and of the least agreement, where a link is weakest."""
    rng = random.Random(17)
    pairs = []
    while len(pairs) < 1500:
        size = rng.randrange(40, 300)
        text = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        copy = text[:]
        for at in rng.sample(range(size), max(1, size // 33)):
            copy[at] = f"n{rng.randrange(10**6)}"
        one, other = shingles(" ".join(text)), shingles(" ".join(copy))
        if 0.75 <= len(one & other) / len(one | other) < 0.8:
            pairs.append((" ".join(text), " ".join(copy)))
    sides = [minhash.signatures(*minhash.shingle_sets(pa.array(list(side))), len(pairs)) for side in zip(*pairs)]
    meet = (sides[0][3] == sides[1][3]).any(1)
    agree = ((sides[0][4] == sides[1][4]).mean(1) - 1 / 256) / (1 - 1 / 256) >= minhash.LEAST_AGREEMENT
    assert (~(meet & agree)).sum() <= 1
    assert minhash.similar(*(pa.array(list(side)) for side in zip(*pairs))).all()


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (7, "a b c d e"), (8, "A B C D E")]


def test_near_duplicates_on_edge_rows(spark, documents, long_text):
    rows = [*EDGES, (9, long_text), (10, long_text + " end")]
    clashing = documents(rows).selectExpr("*", "1 AS id", "2 AS bands", "3 AS component_id", "4 AS n")
    check_near(minhash.near_duplicates(clashing), rows)
    assert minhash.near_duplicates(documents([])).count() == 0
    repeated = minhash.near_duplicates(documents([(3, "x y z v w"), (3, "x y z v w"), (None, "x y z v w"), (5, "x y z v w")]))
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in repeated.collect()) == [
        ("3", 3, True), ("3", 3, True), ("5", 3, False), ("None", None, True)
    ]


def test_keep_one_of_each_group(spark, documents):
    rows = [(3, "x y z v w"), (3, "x y z v w"), (5, "X y z v w"), (6, None), (None, "q"), (7, "other words stand here now")]
    docs = documents(rows).selectExpr("*", "1 AS kept")
    left = minhash.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["3", "6", "7", "None"]


def test_signatures_agree_as_sets_do():
    words = [f"w{i}" for i in range(400)]
    column = pa.array([" ".join(words), " ".join(words[:330] + [f"z{i}" for i in range(70)]), "unrelated text of five words"])
    owner, values = minhash.shingle_sets(column)
    *_, sketch = minhash.signatures(owner, values, 3)
    rows = pa.array([row.tobytes() for row in sketch])
    sets = [shingles(value.as_py()) for value in column]
    exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert minhash.agreement(rows.take([0]), rows.take([1]))[0] == pytest.approx(exact, abs=0.12)
    assert minhash.agreement(rows.take([0]), rows.take([2]))[0] < 0.05


def test_components_by_stars(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 230)]
    pairs += [(300, i) for i in range(301, 360)] + [(5, 5), (None, 1)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b")
    assert {(r["node"], r["component"]) for r in found.collect()} == {(i, root(i)) for i in parent if root(i) != i}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# Repeated passages


def removed(rows):
    first = {}
    words = {i: (text or "").encode().split() for i, text in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    out = {}
    for i, own in words.items():
        stays = [True] * len(own)
        for k in range(len(own) - 49):
            if first[tuple(own[k : k + 50])] < i:
                stays[k : k + 50] = [False] * 50
        left = [w for w, keep in zip(own, stays) if keep]
        out[i] = (len(own), len(own) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())
    return out


def check_removed(df, rows):
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}
    assert found == removed(rows)


def test_removed_words_match_brute_force(spark):
    check_removed(queries.QUERIES["op3_substring_dedup"](spark, SMALL), texts_of(spark))


def passages(seed):
    rng = random.Random(seed)
    shared = [[f"p{p}_{i % rng.choice([7, 200])}" for i in range(rng.choice([49, 50, 51, 60, 120]))] for p in range(6)]
    rows = []
    for n in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"u{rng.randrange(400)}" for _ in range(rng.randrange(60))]
            words += rng.choice(shared)[rng.choice([0, 0, 1, 5]) :]
        rows.append((rng.randrange(10**6) + n * 10**6, rng.choice([" ", "\n", "  "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages_match_brute_force(spark, documents, seed):
    rows = passages(seed)
    check_removed(repeats.removal_digests(documents(rows)), rows)


def test_removal_on_edge_rows(spark, documents, long_text):
    same = " ".join(["same"] * 120)
    rows = [*EDGES, (20, same), (21, same), (22, " ".join(["same"] * 49)), (30, long_text), (31, long_text), (32, same + " x")]
    clashing = documents(rows).selectExpr("*", "1 AS phrase", "2 AS low", "3 AS spans", "4 AS text_key")
    check_removed(repeats.removal_digests(clashing), rows)
    assert repeats.removal_digests(documents([])).count() == 0
    odd = documents([(1, same), (1, same), (None, same), (None, same), (2, same)])
    found = sorted((str(r["doc_id"]), r["n_removed"]) for r in repeats.removal_digests(odd).collect())
    assert found == [("1", 0), ("1", 0), ("2", 120), ("None", 0), ("None", 0)]


def test_remove_repeats_keeps_rows_and_columns(spark, documents):
    passage = " ".join(f"p{i}" for i in range(55))
    docs = documents([(1, f"a\nb {passage} c"), (2, f"d  {passage}\ne"), (3, None), (4, "x\n y"), (5, passage)])
    docs = docs.selectExpr("*", "7 AS `odd name`", "8 AS spans", "9 AS doc_id2")
    left = repeats.remove_repeats(docs)
    assert left.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert rows[1][0] == f"a\nb {passage} c" and rows[2] == ("d e", 3) and rows[3] == (None, None)
    assert rows[4] == ("x\n y", 4) and rows[5] == ("", 0)


# Fingerprints


def test_fingerprints_of_whole_table(spark):
    rows = sorted(texts_of(spark))
    found = {r["doc_id"]: r for r in queries.QUERIES["op5_fingerprints"](spark, SMALL).collect()}
    assert len(found) == len(rows)
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        row = found[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        (alone,) = fingerprint.fingerprints(pa.array([text]))
        assert row["fingerprint"] == fingerprint.as_text(alone)
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert np.mean([r["near_edited"] > r["near_next"] for r in found.values()]) > 0.97


def test_entropies_follow_the_definition():
    rng = np.random.default_rng(1)
    for size in (16, 17, 300, 5000):
        data = rng.integers(97, 109, size, dtype=np.uint8)
        found = fingerprint.entropies(data)
        assert len(found) == size - fingerprint.RUN + 1
        for i in range(0, len(found), 37):
            counts = np.bincount(data[i : i + fingerprint.RUN])
            spread = int(fingerprint._N_LOG_N[counts].sum())
            assert found[i] == (fingerprint._MOST - spread) * 1000 // fingerprint._MOST
    assert len(fingerprint.entropies(rng.integers(0, 9, 15, dtype=np.uint8))) == 0


def plain_chain(text: bytes) -> list[int]:
    """The chain of filters of one text as whole numbers, each run of bytes looked at by itself."""
    size = len(text)
    runs = [text[i : i + fingerprint.RUN] for i in range(size - fingerprint.RUN + 1)]

    def far(run):
        spread = sum(round(n * np.log2(n) * 65536) for n in Counter(run).values() if n > 1)
        most = round(fingerprint.RUN * np.log2(fingerprint.RUN) * 65536)
        return abs((most - spread) * 1000 // most - fingerprint.TYPICAL)

    rarity = [far(run) for run in runs]
    if not runs:
        chosen = [text] if text else []
    elif len(runs) < fingerprint.FEW_RUNS:
        chosen = runs
    else:
        points = Counter()
        for low in range(len(runs) - fingerprint.NEIGHBOURS + 1):
            points[max(range(low, low + fingerprint.NEIGHBOURS), key=lambda i: (rarity[i], -i))] += 1
        places = [i for i in range(len(runs)) if points[i] >= fingerprint.POPULAR]
        chosen = [runs[i] for i in places or [max(range(len(runs)), key=lambda i: (rarity[i], -i))]]
    chain = []
    for low in range(0, len(chosen), fingerprint.FILTER_FEATURES):
        bits = 0
        for run in chosen[low : low + fingerprint.FILTER_FEATURES]:
            data = np.frombuffer(run, np.uint8)
            (hashed,) = fingerprint._window_hashes(data, np.array([0]), np.array([len(run)])).tolist()
            for k in range(fingerprint.FILTER_HASHES):
                bits |= 1 << (hashed >> 11 * k) % fingerprint.FILTER_BITS
        chain.append(bits)
    return chain


def plain_likeness(one: list[int], other: list[int]) -> float:
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    few, many = sorted((one, other), key=len)
    total = 0.0
    for a in few:
        scores = []
        for b in many:
            chance = a.bit_count() * b.bit_count() / fingerprint.FILTER_BITS
            room = min(a.bit_count(), b.bit_count()) - chance
            scores.append(((a & b).bit_count() - chance) / room if room > 0 else 1.0)
        total += a.bit_count() * max(scores)
    return min(max(total / sum(a.bit_count() for a in few), 0.0), 1.0)


def test_features_filters_and_likeness_match_plain_python(spark, documents):
    rng = random.Random(21)
    letters = "etaoin shrdlu,.é"
    texts = ["", "tiny", "exactly 16 bytes", "a" * 400, "ab" * 300]
    texts += ["".join(rng.choices(letters, k=size)) for size in (30, 110, 111, 112, 400, 3000, 9000)]
    texts += [texts[-1][2000:6000] + "".join(rng.choices(letters, k=900)), texts[-1], texts[-2] + "!"]
    found = {r["doc_id"]: r for r in fingerprint.compare_edited(documents(list(enumerate(texts)))).collect()}
    chains = [plain_chain(text.encode()) for text in texts]
    for i, text in enumerate(texts):
        following = (i + 1) % len(texts)
        rows = fingerprint.fingerprints(pa.array([text]))[0]
        assert sorted(np.flatnonzero(np.unpackbits(row)).tolist() for row in rows) == sorted(
            [bit for bit in range(fingerprint.FILTER_BITS) if bits >> bit & 1] for bits in chains[i]
        )
        changed = plain_chain(fingerprint.edited(text, texts[following]).encode())
        assert found[i]["near_edited"] == pytest.approx(plain_likeness(chains[i], changed))
        assert found[i]["near_next"] == pytest.approx(plain_likeness(chains[i], chains[following]))


def test_fingerprints_on_edge_rows(spark, documents, long_text):
    rows = [(1, None), (2, ""), (3, "short"), (4, "short"), (5, "é" * 40), (6, "a" * 900), (7, long_text), (None, "no id")]
    docs = documents(rows).selectExpr("*", "1 AS bucket", "2 AS carried", "3 AS fingerprint")
    found = {r["doc_id"]: r for r in fingerprint.compare_edited(docs).collect()}
    assert len(found) == 8
    assert found[3]["fingerprint"] == found[4]["fingerprint"] and found[3]["near_next"] == 1.0
    assert found[1]["near_next"] == 1.0 and found[1]["n_chars"] == 0 and found[5]["n_chars"] == 40
    first = hashlib.sha256((long_text[: len(long_text) - len(long_text) // 2] + "no id").encode()).hexdigest()
    assert found[7]["edited_sha256"] == first  # the row without an id comes first
    assert fingerprint.compare_edited(documents([])).count() == 0
    (single,) = fingerprint.compare_edited(documents([(1, "abcdef" * 20)])).collect()
    assert single["near_next"] == 1.0
    twice = fingerprint.compare_edited(documents([(1, "x y"), (1, "x y"), (2, "z" * 99)])).collect()
    assert len(twice) == 3


def test_shared_passages_share_features():
    rng = random.Random(8)
    text = " ".join(f"word{rng.randrange(3000)}" for _ in range(600))
    other = " ".join(f"term{rng.randrange(3000)}" for _ in range(600))
    same, shifted, unlike = fingerprint.fingerprints(pa.array([text, "x" * 7 + text, other]))
    assert fingerprint.likeness(same, shifted) > 0.95
    assert fingerprint.likeness(same, unlike) < 0.2
    assert fingerprint.likenesses([same, same], [shifted, unlike])[0] == pytest.approx(fingerprint.likeness(same, shifted))


# Packing


def test_packing_of_whole_table(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = texts_of(spark)
    encoded = tokenizer.encode_batch([text or "" for _, text in rows], add_special_tokens=False)
    expected = {}
    for (i, _), encoding in zip(rows, encoded):
        ids = [*encoding.ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at : at + 4096]
            expected[i, n] = (at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
    found = queries.QUERIES["op4_best_fit_packing"](spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == expected
    sequences = defaultdict(list)
    for row in found:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(length for _, length, _ in expected.values()) // 4096)
    assert len(sequences) <= least + 1


def fewest_bins(lengths, capacity):
    """Exact, for a handful of lengths."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] >= lengths[i] and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] - lengths[i]] + bins[k + 1 :])
        place(i + 1, bins + [capacity - lengths[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_valid_and_near_optimal_and_reduction_loses_nothing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 50])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 11))]
    counts = Counter(lengths)
    plan = packing.make_plan(counts, capacity)
    places = packing.Places.of(plan)
    fill = defaultdict(list)
    for length, n in counts.items():
        for bin_, offset in zip(*(x.tolist() for x in places.find(np.full(n, length), np.arange(n)))):
            fill[bin_].append((offset, length))
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    fixed = packing.Plan()
    packing.reduce_by_dominance(left, fixed, capacity)
    rest = [length for length, n in enumerate(left.tolist()) for _ in range(n)]
    best = fewest_bins(lengths, capacity)
    assert fixed.sequences + fewest_bins(rest, capacity) == best  # what is fixed belongs to a best packing
    assert plan.sequences <= best + 1


def test_packing_on_edge_rows(spark, documents, long_text):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [*EDGES, (9, long_text), (10, "it's a<|endoftext|>b don't Ünïcödé ÀÉ ß × é́ 12,5 日本 \x00 a\x00b"), (11, "x"), (11, "x")]
    docs = documents([*rows, (None, "no id")]).selectExpr("*", "1 AS length", "2 AS salt", "3 AS number", "4 AS piece")
    found = packing.pack_documents(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, text in [*rows, (None, "no id")]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = [r for r in found if r["doc_id"] == i and r["piece"] == 0]
        assert pieces and all(p["ids_crc32"] == zlib.crc32(np.array(ids[:4096], "<u4").tobytes()) for p in pieces)
    assert len([r for r in found if r["doc_id"] == 11]) == 2
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert packing.pack_documents(documents([]), path).count() == 0


def test_names_of_special_tokens_in_a_text_are_those_tokens():
    """As the library has it: found in the text as it is, before the text is taken apart, but not across two texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [
        "see <|endoftext|> here", "a<|endoftext|>b", "<|EndOfText|>", "x <|startoftext|><|endoftext|>", "<|endoftext| >",
        "don<|endoftext|>'t", "DON'T<|ENDOFTEXT|>", "é<|endoftext|>\u0301 z", "<|<|endoftext|>|>", "\x00<|endoftext|>\x00 1",
        "cut <|endof", "text|> here", "", "<|startoftext|>", "日<|endoftext|>本 É",
    ]
    tokens, first = packing.tokenizer(path).encode(pa.array(rows))
    expected = [encoding.ids for encoding in library.encode_batch(rows, add_special_tokens=False)]
    assert [tokens[a:b].tolist() for a, b in zip(first, first[1:])] == expected
    assert expected[0] == [862, 49407, 763]
    rng = random.Random(9)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "É", "'s", " ", "\u0301", "Word", "7", "\x00", "<"]
    rows = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(3000)]
    tokens, first = packing.tokenizer(path).encode(pa.array(rows))
    expected = [encoding.ids for encoding in library.encode_batch(rows, add_special_tokens=False)]
    assert [tokens[a:b].tolist() for a, b in zip(first, first[1:])] == expected


@pytest.mark.parametrize(
    "counts",
    [
        {1500: 10**9},
        {1500: 10**9, 1400: 10**9 + 1, 1300: 10**9 + 2},
        {n: 10**9 + n for n in range(1300, 1600)},
        {n: 10**9 for n in range(1, 4097, 7)},
    ],
)
def test_plan_follows_the_number_of_lengths_not_of_documents(counts):
    plan = packing.make_plan(counts)
    assert len(plan.runs) <= 8 * len(counts)
    packed = dict.fromkeys(counts, 0)
    for run in plan.runs:
        packed[run.length] += run.pieces
    assert packed == counts
    assert plan.sequences * packing.CAPACITY >= sum(length * n for length, n in counts.items())


def test_equal_lengths_fixed_together_give_as_many_sequences_as_one_by_one():
    for n in range(1, 40):
        assert packing.make_plan({1500: n}).sequences == -(-n // 2)
        assert packing.make_plan({1500: n, 1400: n}).sequences == -(-2 * n // 2)


def test_parts_pushed_out_of_the_memo_keep_their_ids(monkeypatch):
    words = [f"wört{i} Größe{i * 7919 % 1000}x y{i}'s" for i in range(3000)]
    texts = pa.array([" ".join(words[i : i + 50]) for i in range(0, 3000, 10)])
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = packing.PartTokenizer(path).encode(texts)
    monkeypatch.setattr(packing, "MEMO_PARTS", 100)
    own = packing.PartTokenizer(path)
    for _ in range(2):
        parts = [own.encode(texts.slice(i, 1))[0] for i in range(len(texts))]
        assert np.array_equal(np.concatenate(parts), whole[0])
    assert len(own.memo) + len(own.older) < 1000


def located(spark, rows):
    """(doc_id, low) of the places that the automata find for documents with their patterns."""
    df = spark.createDataFrame([(i, 0, text, found) for i, text, found in rows], "doc_id long, text_key long, text string, patterns array<string>")
    return sorted((r["doc_id"], r["low"]) for r in repeats.phrase_places(df).collect())


def test_the_hits_of_the_automaton_are_the_places(spark, documents):
    """Places come from patterns only: without a pattern its places are gone, and a pattern changed in a letter finds none."""
    draw = random.Random(3)
    passage = " ".join(f"{draw.choice('abcdé')}{draw.randrange(500)}" for _ in range(130))
    texts = {1: f"one {passage} end", 2: f"another\n{passage}\tstop here", 3: "nothing in common " * 40}
    said = repeats.phrases(repeats.keyed(documents(list(texts.items()))))
    known = sorted(r["words"] for r in repeats.patterns(repeats.store(said, "said")).collect())
    assert len(known) > 3 and all(pattern in passage for pattern in known)
    rows = lambda patterns: [(i, text, patterns) for i, text in texts.items()]
    whole = located(spark, rows(known))
    assert {i for i, _ in whole} == {1, 2} and located(spark, rows([])) == []
    for left_out in known[:3]:
        rest = located(spark, rows([p for p in known if p != left_out]))
        assert set(rest) < set(whole) and {i for i, _ in set(whole) - set(rest)} == {1, 2}
        assert rest == located(spark, rows([p if p != left_out else f"{p}x" for p in known]))


def test_patterns_match_whole_words_only():
    words = textgrid.split(pa.array(["xa b c", "a b cx", "a  b\tc", None, "", "é b c a b c"]))
    assert repeats.hits(words, {"a b c"}).tolist() == [6, 12]
    assert repeats.hits(words, {"é b c", "b c"}).tolist() == [1, 7, 9, 10, 13]
    assert repeats.hits(words, set()).tolist() == []


def test_of_rows_with_equal_id_the_least_text_stays(spark):
    docs = spark.createDataFrame(
        [(1, "b text of five words", "de"), (1, "a text of five words", "fr"), (1, "a text of five words", "en"), (2, "other", None)],
        "doc_id long, text string, lang string",
    )
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a text of five words", "en"), (2, "other", None)]


def test_sets_of_many_texts_are_those_of_each(long_text):
    texts = pa.array([long_text, None, "", "a b c d e f", "é " * 9, long_text[: len(long_text) // 2]] * 4)
    owner, values = minhash.sliced_sets(texts)
    for i in range(len(texts)):
        alone = minhash.shingle_sets(texts.slice(i, 1))[1]
        assert sorted(values[owner == i].tolist()) == sorted(alone.tolist())
