"""Windows that no shared shingle aligns: items whose parts stand in another order."""

import random
from collections import Counter

from chunkloom.llm import decontaminate


def _grams(tokens):
    return Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))


def _best(tokens, goal):
    """``(similarity, start)`` of the best of all windows, the first of equal ones."""
    found = []
    for start in range(-len(goal), len(tokens)):
        window = _grams(tokens[max(start, 0) : start + len(goal)])
        joint = sum((window | _grams(goal)).values())
        if joint:
            found.append((sum((window & _grams(goal)).values()) / joint, -max(start, 0)))
    return max(found, default=(0, 0))


def test_parts_in_another_order_equal_all_windows(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(500)]
    items = [rng.choices(words, k=k) for k in (36, 48, 60, 60, 90, 12)]
    items.append((rng.choices(words, k=10) * 4)[:38])
    docs = []
    for k, item in enumerate(items):
        foreign = lambda n: [f"f{k}x{rng.randrange(10**6)}" for _ in range(n)]
        half, third = len(item) // 2, len(item) // 3
        halves = item[half:] + item[:half]
        sentences = item[2 * third :] + item[third : 2 * third] + item[:third]
        for part in (halves, sentences, item):
            docs += [foreign(40) + part + foreign(40), part + foreign(9), foreign(9) + part, part]
        docs += [foreign(3) + item + item + halves, item[: -len(item) // 5], foreign(20) + item[len(item) // 5 :]]
        docs += [item[:half] + foreign(2) + item[half:], foreign(30)]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id bigint, text string")
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    want = {}
    for d, tokens in enumerate(docs):
        for k, goal in enumerate(items):
            similarity, back = _best(tokens, goal)
            if similarity >= 0.75:
                want[d, k] = (round(similarity, 9), -back)
    rows = decontaminate.contaminated(df, table).collect()
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in rows} == want
    assert len(rows) == len(want)
    assert (0, 0) in want and (17 * 3, 3) in want  # exchanged halves within foreign words
    assert decontaminate.decontaminate(df, table).count() == len({i for i in range(len(docs))} - {d for d, _ in want})
