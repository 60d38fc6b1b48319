"""A batch looks up each of its distinct words once, and blanks and empty texts give the tokenizer's ids."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kestrel.llm.wavelet import WordMemo


class Counted(WordMemo):
    looked_up = 0

    def __getitem__(self, word):
        self.looked_up += 1
        return super().__getitem__(word)


def test_distinct_words_are_looked_up_once():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    memo = Counted(tokenizer)
    for texts in (["one two  two, Straße.\nend", "", " ", "two one two one é 漢字 two."] * 50, ["", ""], []):
        memo.looked_up = 0
        ids, n = memo.encode(texts) if texts else (np.zeros(0), np.zeros(0, int))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert memo.looked_up <= 12
