import numpy as np

from floorlens.llm.words import Memo


class Counted(dict):
    looks = 0

    def _look(name):
        def look(self, *args):
            Counted.looks += 1
            return getattr(dict, name)(self, *args)

        return look

    get, __getitem__, __contains__ = _look("get"), _look("__getitem__"), _look("__contains__")


def test_known_pieces_are_looked_up_once():
    """Before, each piece was looked up twice."""
    memo = Memo(lambda words: (np.array([len(w) for w in words]), np.array([ord(c) for w in words for c in w])))
    pieces = ["ab", "c", "ab", "def"]
    assert memo.places(pieces).tolist() == [0, 1, 0, 2]
    memo.place = Counted(memo.place)
    assert memo.places(pieces).tolist() == [0, 1, 0, 2] and Counted.looks == len(pieces)
    assert memo.places(["new", "def", "new"]).tolist() == [3, 2, 3]
    ends, values = memo.runs(memo.places(["def", "new"]))
    assert ends.tolist() == [3, 6] and "".join(map(chr, values)) == "defnew"
