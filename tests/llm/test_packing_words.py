"""Ids by remembered words against the tokenizer on whole texts."""

import numpy as np
import pytest

from chunkloom.llm import packing

ODD = [
    "",
    " \t\r\n",
    "ÀÉ ß ÿ ð÷þ × Ünï—cödé",
    "it's Don'T 's 'T 're",
    "a1b2 x_y-z (Foo), ÉCOLE!  x y\u0085z",
    "é ﬁ İ ı ǅ 中文 😀 a😀b é",
    "<|startoftext|> a <|ENDOFTEXT|>",
    "\x0b\x0c\x1c a\x00b ªº µ ---!!! &amp;",
    "Same same SAME, same. " * 50,
    "x" * 5000,
]


@pytest.mark.parametrize("remembered", [1_000_000, 5])
def test_word_ids_equal_the_tokenizer(monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)  # 5: begins anew for each batch
    encode = packing.WordIds(packing.tokenizer_path())
    for _ in range(2):
        for text, found in zip(ODD, encode(ODD)):
            ids = encode.tokenizer.encode(text, add_special_tokens=False).ids
            assert found == np.asarray(ids, dtype="<u4").tobytes(), text[:40]
