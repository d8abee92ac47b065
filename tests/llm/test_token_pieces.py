"""A word is asked for once, whatever marks close it; ids stay those of the whole text."""

import random

import numpy as np

from caseflow.llm import tokens

NAME = "byte_bpe_50k.json"


def test_a_word_is_remembered_without_its_closing_marks():
    enc = tokens.Encoder(NAME)
    words = [f"blentionwh{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    marks = ["", ",", ".", "!?", "###", ");"]
    enc.encode([" ".join(["x"] + [w + m for w in words]) for m in marks])
    assert len(enc.known) < 2 * len(words)


def test_ids_with_marks_are_those_of_the_whole_text():
    rng = random.Random(7)
    ends = ["", ",", ".", "'", "'s", "'.", "%%%", "×.", "÷,", "é,", "é,", "中.", "ł;", "3.", "\n", "\n.", ".\n",
            "\0.", "\u0085,", "\x1c.", "<|endoftext|>", "\U0001f600!", "ª,", "µ.", "ǅ:", "ʰ-", "_", "--", "’."]
    stems = ["", "word", "don't", "It's", "école", "x\ny", "á", "9", "ü", "we'", "'ll"]
    texts = [" ".join(rng.choice(stems) + rng.choice(ends) for _ in range(rng.randrange(1, 9))) for _ in range(6000)]
    enc = tokens.Encoder(NAME)
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.lib.encode_batch_fast(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want
    assert enc.encode(texts[::-1]) == want[::-1]
