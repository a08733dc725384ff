"""The workers' table of parts' ids, with more parts than it may hold."""

import numpy as np

from chronolens.llm.common import Known, word_spans


def test_a_warm_table_and_a_text_with_more_parts_than_it_holds():
    known = Known(4)

    def ids(*texts):
        raw, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
        starts, ends, row = word_spans(raw, offsets)
        got = known.ids_of(raw, starts, ends, row, len(texts), lambda parts: [np.array([p[0], len(p)], np.uint32) for p in parts])
        return [x.tolist() for x in got]

    def expected(*texts):
        return [[x for w in t.split() for x in (ord(w[0]), len(w))] for t in texts]

    for texts in (["a bb c"], ["a d eee f gg h a", "", "bb h"], ["z"], ["c d a bb e f"], ["a"]):
        assert ids(*texts) == expected(*texts)
