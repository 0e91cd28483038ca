"""Lines that open no turn keep their text."""

from chunkloom.llm import chat


def test_continuation_keeps_words_that_look_like_markers(spark):
    turns = [
        ("user", ["User: How much is it?", "Q: why"]),
        ("assistant", ["Assistant: See here.", "Answer: 42", "A | B", "a > b holds", "- Q: why", "  plain"]),
    ]
    rows = [
        (conv, turn, line, text, role, line == 0)
        for conv in range(6)
        for turn, (role, texts) in enumerate(turns * 4)
        for line, text in enumerate(texts)
    ]
    order = ["turn_no", "line_no"]
    lines = spark.createDataFrame(
        rows, "conv_id bigint, turn_no int, line_no int, text string, role string, opens boolean"
    )
    model = chat.train(lines, order)
    found = chat.parse_transcripts(lines.select("conv_id", *order, "text"), order, model).collect()
    shown = [r.rendered for r in sorted(found, key=lambda r: (r.conv_id, r.line))]
    bodies = {"User: How much is it?": "<|user|>\nHow much is it?", "Assistant: See here.": "<|assistant|>\nSee here."}
    assert shown == [bodies.get(r[3], r[3]) for r in rows]
