"""Operators next to plain versions of their whole: rules, naive Bayes, marginals, sequences, chats."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np

from chunkloom.llm import chat, decontaminate, html_extract, language_id, packing, quality
from chunkloom.llm.common import held_out

WORDS = "some of the words that a text may hold, and others. Why? 12 | 9 UP down!".split()


def _texts(n, seed):
    rng = random.Random(seed)
    return [rng.choice(["\n", " "]).join(rng.choices(WORDS, k=rng.randrange(0, 60))) for _ in range(n)]


def test_compiled_score_equals_rules(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*_texts(300, 1), None, ""])], "doc_id bigint, text string")
    names = [f"q_{n}" for n in quality.statistics()]
    table = quality.with_statistics(docs, [quality.F.col("doc_id")])
    x = table.orderBy("doc_id").toPandas()[names].to_numpy(float)
    rules, intercept = quality.fit(x, (x[:, 3] + rng.normal(size=len(x)) > np.median(x[:, 3])).astype(float))
    assert len(rules) > 3 and any(len(r.terms) > 1 for r, _ in rules)
    want = 1 / (1 + np.exp(-(intercept + sum(w * r.holds(x) for r, w in rules))))
    got = table.select("doc_id", quality.compile_score(rules, intercept).alias("s")).orderBy("doc_id").collect()
    assert np.allclose([r.s for r in got], want, atol=1e-12)


def test_quality_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)) or ([], 0.0))
    docs = spark.createDataFrame([(1, t) for t in _texts(90, 2)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, i % 2) for i in range(70)], "doc_id bigint, quality int")
    quality.train(docs, labels, sample=50)
    assert seen == [50]


def _grams(text):
    value, found = text.lower(), Counter()
    for n in (1, 2, 3):
        for i in range(len(value) - n + 1):
            code = 0
            for c in value[i : i + n]:
                code = code * 0x110000 + ord(c)
            found[((code + n) * 0x9E3779B97F4A7C15) % 2**64 >> 64 - language_id.LOG_BUCKETS] += 1
    return found


def test_language_equals_plain_naive_bayes(spark):
    rng = random.Random(3)
    letters = {"aa": "abcde fg", "bb": "defgh ab", "cc": "ßüöx cd"}
    rows = [(i, "".join(rng.choices(letters[l], k=rng.randrange(1, 25))), l) for i in range(160) for l in [rng.choice("aaabbc") * 2]]
    rows += [(900, None, "aa"), (901, "²³ 12", "aa"), (902, "abc", None), (None, "fg ab", "bb")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify_language(df).collect()}
    counts, sizes = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang and not got[i].held_out:
            counts[lang].update(_grams(text or ""))
            sizes[lang] += 1
    total = {l: sum(c.values()) + 2**language_id.LOG_BUCKETS for l, c in counts.items()}
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        chances = {
            l: math.log(sizes[l] / sum(sizes.values()))
            + sum(n * math.log((counts[l][b] + 1) / total[l]) for b, n in _grams(text).items())
            for l in counts
        }
        best = max(chances, key=chances.get)
        share = 1 / sum(math.exp(c - chances[best]) for c in chances.values())
        assert got[i].lang_pred == best and abs(got[i].score - share) < 1e-3
    assert any(r.held_out for r in got.values())


def test_rare_language_is_learned_from_a_small_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LEAST", 20)
    rows = [(i, "abc de", "aa") for i in range(4000)] + [(10_000 + i, "xyz", "bb") for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    languages, matrix, _ = language_id.train(df, ~held_out(), sample=40)
    assert languages == ["aa", "bb"] and np.ptp(matrix[1]) > 1


def test_marginals_equal_enumeration():
    rng = random.Random(6)
    tags = ["div", "article", "p", "nav", "span"]
    for _ in range(40):
        n = rng.randrange(1, 10)
        nodes = [
            [rng.randrange(i) if i else -1, rng.choice(tags), rng.random() < 0.3, rng.random() < 0.3]
            + [rng.randrange(300), rng.randrange(50), rng.randrange(9), False]
            for i in range(n)
        ]
        weights = {f: rng.uniform(-0.7, 0.7) for f in html_extract.FEATURES}
        child = [[[p := rng.uniform(0.02, 0.98), 1 - p] for _ in range(2)] for _ in range(2)]
        model = html_extract.Model(weights, child, rng.uniform(0.1, 0.9))
        mass = np.zeros((n, 2))
        for states in itertools.product((0, 1), repeat=n):
            weight = math.exp(sum(model.own(x) * s for x, s in zip(nodes, states)))
            for x, s in zip(nodes[1:], states[1:]):
                weight *= child[html_extract.opens(x[1], x[2])][states[x[0]]][s]
            mass[range(n), states] += weight
        assert np.allclose(model.marginals(nodes), np.log(mass[:, 1] / mass[:, 0]), atol=1e-9)


def test_sequences_have_no_gaps(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(0, 900))) for _ in range(120)] + [None, "", "long " * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = packing.pack(df).collect()
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(held) <= least + 1


def test_ids_of_chats_keep_type_and_null_ones_stay_apart(spark):
    rows = [(c, 0, "user", "User: Why?") for c in ("-1", None, "x y")] + [(None, 1, "assistant", "Assistant: So.")]
    table = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    lines, order = chat.transcripts(table), ["turn_no", "line_no"]
    model = chat.train(lines, order)
    got = sorted(((r.conv_id or "", r.line) for r in chat.parse_transcripts(lines, order, model).collect()))
    assert got == [("", 0), ("", 1), ("-1", 0), ("x y", 0)]
    numbers = lines.withColumn("conv_id", chat.F.col("conv_id").try_cast("bigint")).filter("conv_id = -1 OR conv_id IS NULL")
    found = chat.parse_transcripts(numbers, order, model)
    assert found.schema["conv_id"].dataType.simpleString() == "bigint"
    assert sorted(((r.conv_id is None), r.line) for r in found.collect())[0] == (False, 0)


def test_roles_of_held_out_conversations(spark, sf_dir):
    lines = chat.transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    order = ["turn_no", "line_no"]
    model = chat.train(lines.filter(~held_out("conv_id")), order)
    numbered = chat.number_rows(lines.filter("conv_id IS NOT NULL"), order, within=["conv_id"], name="line")
    truth = {(r.conv_id, r.line): r.role for r in numbered.filter(held_out("conv_id")).collect()}
    found = chat.parse_transcripts(lines.select("conv_id", *order, "text"), order, model).collect()
    got = {(r.conv_id, r.line): r.role for r in found}
    known = [k for k, role in truth.items() if role is not None]
    assert len(known) > 20 and sum(got[k] == truth[k] for k in known) >= 0.9 * len(known)


def test_bags_count_as_multisets(spark):
    rng = random.Random(9)
    pairs = [([rng.randrange(6) for _ in range(rng.randrange(0, 30))], [rng.randrange(6) for _ in range(rng.randrange(1, 30))]) for _ in range(80)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<bigint>, b array<bigint>")
    bags = df.select("i", decontaminate.bag("a").alias("a"), decontaminate.bag("b").alias("b"))
    got = bags.select("i", decontaminate.weighted_similarity("a", "b").alias("s")).collect()
    for r in got:
        a, b = map(Counter, pairs[r.i])
        assert abs(r.s - sum((a & b).values()) / sum((a | b).values())) < 1e-12


def test_long_items_end(spark):
    rng = random.Random(10)
    passages = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (60, 800, 2500)]
    docs = [(i, " ".join(["before"] * 7 + p + ["behind"] * 9)) for i, p in enumerate(passages)]
    items = [(i, " ".join(p)) for i, p in enumerate(passages)]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert sorted((r.doc_id, r.item_id, r.similarity, r.start_word) for r in found.collect()) == [(i, i, 1.0, 7) for i in range(3)]
