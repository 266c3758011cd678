from collections import Counter

from farelake.llm.linededup import dedup_lines


def normal(line):
    for c in "\t\n\x0b\f\r":
        line = line.replace(c, " ")
    return " ".join(x for x in line.lower().split(" ") if x)


def expected(rows, window=2, long_line=50):
    """Brute force over distinct (id, text), ids ascending with nulls first."""
    docs = {row: [(n, normal(x)) for n, x in enumerate((row[1] or "").split("\n")) if normal(x)] for row in rows}
    seen = {}
    for row in docs:
        lines = docs[row]
        spans = [lines[k : k + window] for k in range(len(lines) - window + 1)]
        spans += [[x] for x in lines if len(x[1].split(" ")) >= long_line]
        for span in spans:
            key = (len(span) > 1, tuple(body for _, body in span))
            seen.setdefault(key, []).append((row, [n for n, _ in span]))
    order = {i: k for k, i in enumerate(sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0)))}
    cut = {row: set() for row in docs}
    for places in seen.values():
        first = min(places, key=lambda p: (order[p[0][0]], p[1]))
        for row, span in places:
            if (row, span) != first:
                cut[row] |= set(range(span[0], span[-1] + 1))
    return cut


def test_brute_force(edge, edge_rows):
    # Two texts of one id tie: their order is that of a hash, so they are compared without it.
    tied = {10}
    cut = expected([r for r in edge_rows if r[0] not in tied])
    got = dedup_lines(edge.where("doc_id is null or doc_id <> 10")).collect()
    assert len(got) == len([r for r in edge_rows if r[0] not in tied])
    by_text = Counter()
    for row in got:
        by_text[(row.doc_id, row.n_lines, row.n_removed, row.text)] += 1
    want = Counter()
    for i, text in edge_rows:
        if i in tied:
            continue
        lines = [] if text is None else text.split("\n")
        gone = cut[(i, text)]
        left = None if text is None else "\n".join(x for n, x in enumerate(lines) if n not in gone)
        want[(i, len(lines), len(gone), left)] += 1
    assert by_text == want


def test_ids_that_tie_keep_one_copy(edge):
    rows = dedup_lines(edge.where("doc_id = 10")).collect()
    assert sorted(r.n_removed for r in rows) == [0, 2]


def test_extra_columns_stay(edge):
    assert {"lang", "source", "n_chars", "cls", "W", "kept"} <= set(dedup_lines(edge).columns)


def test_empty(empty):
    assert dedup_lines(empty).count() == 0
