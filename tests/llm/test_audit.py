"""The filter audit against a plain count of every order and step."""

import itertools
import re

from chronolens.llm import audit

SCHEMA = "doc_id long, text string, source string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    def fails(row):
        i, t, _ = row
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        caps = len(re.findall("[A-Z]", t))
        others = [j for j, u, _ in docs if (u or "") == t]
        same = any(j is not None and (i is None or j < i) for j in others)
        return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * caps > 5 * len(t),
                "D": bool(re.search("[#$%&*|]", t)), "E": same}

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = [(i, s or "", fails((i, t, s))) for i, t, s in docs]
    out = {}
    for part in {s for _, s, _ in rows}:
        own = [(i, f) for i, s, f in rows if s == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                shapley[letter] += len(gone)
                failing = sum(f[letter] for _, f in own)
                left = [x for x in left if not x[1][letter]]
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                                          sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter]
        for (p, *_), v in out.items():
            if p == part:
                v[6] = shapley[v[6]]
    return out


def test_against_plain_counts(spark):
    long = " ".join(f"word{i}é" for i in range(60))
    caps = " ".join(f"WORD{i}" for i in range(60))
    dull = "a b " * 200
    docs = [(i, t, s) for i, (t, s) in enumerate(itertools.product([long, caps, dull, long + " #", dull + "&", None, "", "x y\u0085z \x1c", "Ä" * 3000], ["web", "books", None]))]
    docs += [(100, long, "web"), (100, long, "web"), (None, long, "web"), (None, "alone", None), (None, "alone", "web"), (7, caps, "books"), (-5, dull + "&", "web"), (3, "Z", "web")]
    docs += [(1000 + i, long + " |", "hot") for i in range(300)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 1200, 3)] + [(100, 0, 0), (100, 1, 1), (None, 1, 1), (5555, 1, 1), (4, None, None)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    got = audit.audit(spark.createDataFrame([(*d, 1, "n") for d in docs], SCHEMA).repartition(5), spark.createDataFrame(labels, LABELS))
    rows = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got.collect()}
    assert rows == plain(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "s", 0, "")], SCHEMA)
    assert audit.audit(one, labels).count() == 600


def test_fields_do_not_overflow_into_each_other():
    most = (1 << 64) - 1
    for mask in range(32):
        fields = audit.unpacked(audit.packed(mask) * most)
        assert set(fields.tolist()) <= {0, most} and int(fields[-1]) == most
        removed = fields[:-1].reshape(-1, 5) > 0
        assert (removed.sum(1) == (mask > 0)).all()


def test_masks_of_texts():
    assert audit.mask_of(b"") == 1 and audit.mask_of("é".encode() * 10) == 1
    assert audit.mask_of(b"A" + b"b" * 19) == 1 and audit.mask_of(b"A" + b"b" * 18) == 5  # 5 of 100 is allowed
    assert audit.mask_of(b" ".join([b"a"] * 50)) == 2 and audit.mask_of(b"|") == 9
