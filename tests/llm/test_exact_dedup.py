import hashlib
import re

from pyspark.sql import functions as F

from verdigris.llm import exact_dedup


def brute(rows):
    groups = {}
    for number, row in enumerate(rows):
        norm = re.sub("[\x20\x09-\x0d]+", " ", row[1] or "")
        groups.setdefault(norm, []).append((row[0] is None, row[0], number))
    out = []
    for norm, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1] or 0))
        for _, doc_id, _ in members:
            out.append((doc_id, first[1], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups(make_docs, odd_rows):
    rows = odd_rows + [(20, "x" * 80 + "a"), (21, "x" * 80 + "b"), (22, "x" * 80 + "\x0ba"), (23, "x" * 80 + " a")]
    digest = {"text_sha256": F.sha2(exact_dedup.normalised(), 256)}
    found = exact_dedup.exact_duplicates(make_docs(rows, clashing=True), carry=digest).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == brute(rows)
    # One row of each group stays, repeated rows included.
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})


def test_kept_rows_have_all_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows, clashing=True)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 0 and ids.count(4) == 1 and 1 in ids and 2 not in ids


def test_null_id_yields_to_any_other(make_docs):
    found = exact_dedup.exact_duplicates(make_docs([(None, "a"), (9, "a")])).collect()
    assert {r.keep_id for r in found} == {9} and sorted(r.kept for r in found) == [False, True]


def test_empty_table(make_docs):
    assert exact_dedup.exact_duplicates(make_docs([])).count() == 0
