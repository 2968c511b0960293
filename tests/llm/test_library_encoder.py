"""How much the tokenizers library holds at once, and that units encoded side by side keep their ids."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martforge.llm.token_files import LibraryEncoder

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def many_words(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéß.,'") for _ in range(rnd.randrange(1, 12))) for _ in range(n)]


class Recorder:
    def __init__(self, library):
        self.library, self.texts, self.ids = library, 0, 0

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch_fast(self, texts, **kw):
        out = self.library.encode_batch_fast(texts, **kw)
        self.texts, self.ids = max(self.texts, len(texts)), max(self.ids, sum(len(x.ids) for x in out))
        return out


def test_library_gets_few_units_at_once():
    words = many_words(30_000)
    texts = [" ".join(words[i:i + 300]) for i in range(0, len(words), 300)] + ["a ", " b", "c\n", "\nd", "e '", "'s f", "g's", "h\ni", "", " "]
    encoder = LibraryEncoder(PATH)
    encoder.library = seen = Recorder(encoder.library)
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [x.ids for x in Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)]
    assert 0 < seen.texts <= 4096 and seen.ids < 50_000


def test_units_beside_ends_in_white_space():
    encoder, library = LibraryEncoder(PATH), Tokenizer.from_file(PATH)
    for texts in (["x a  ", "x a ", "x b", "x \n", "x\n"], ["x '", "x s", "x 's t", "x\n's"], ["x 1 2", "x 12 a1", "x . .. a."]):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
