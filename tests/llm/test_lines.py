import random

from folium.llm.lines import _line_ids, clean_pages, repeated_blocks, repeated_lines

SCHEMA = "row_id long, run_id string, source array<string>, page long, blocks array<struct<block_type string, text string, block_order long, attrs map<string,string>>>, coll string, c int"


def pages(spark, rows):
    return spark.createDataFrame([(i, r, s, 1, None if b is None else [("p", t, o, None) for o, t in b], "x", 1) for i, (r, s, b) in enumerate(rows, 1)], SCHEMA)


def test_same_line():
    _, _, ident, words = _line_ids(["The  OLD mill, 1871", "the old-mill 5", "the old mill of", "th3e old mill", "  12 \n\nÉTÉ été"])
    assert ident[0] == ident[1] == ident[3] and ident[2] != ident[0]
    assert words.tolist() == [3, 3, 4, 3, 0, 0, 2]


def test_found_and_removed(spark):
    line = "All rights are reserved"
    rows = [(f"r{i}", ["site"], [(1, f"own text number {chr(97 + i)} here"), (2, f"more {chr(97 + i)} words\n{line.upper() if i % 2 else line} {i}")]) for i in range(6)]
    rows += [("r0", ["site"], [(1, line)]), ("x", [], [(1, line)]), ("y", None, [(1, line)]), ("z", [""], [(1, line)]), ("r1", ["site"], None), ("r2", ["site"], []), ("q", ["other"], [(1, line)]), ("r3", ["site"], [(1, None), (2, "two words")]), ("r3", ["site"], [(1, "two words")])]
    df = pages(spark, rows)
    lines = repeated_lines(df)
    got = {tuple(r) for r in lines.collect()}
    assert got == {(i, 2, 2) for i in range(1, 7)} | {(7, 1, 1)}
    clean = {r.row_id: [(b.block_order, b.text) for b in r.blocks] if r.blocks is not None else None for r in clean_pages(df, lines).collect()}
    assert clean[1] == [(1, "own text number a here"), (2, "more a words")] and clean[7] == [] and clean[8] == [(1, line)]


def test_share_of_runs(spark):
    line = "a line of some words"
    rows = [(f"r{i}", ["s"], [(1, line if i < 5 else f"text {chr(97 + i % 26)}{chr(97 + i // 26)} other thing")]) for i in range(51)]
    assert repeated_lines(pages(spark, rows)).count() == 0
    assert repeated_lines(pages(spark, rows[:50])).count() == 5


def test_blocks_and_empty(spark):
    rows = [(f"r{i}", ["s"], [(1, "first line of notice\nsecond line of notice"), (2, f"own {chr(97 + i // 5)}{chr(97 + i)} text here")]) for i in range(25)]
    got = sorted((r.lines, r.runs) for r in repeated_blocks(pages(spark, rows)).collect())
    assert got == [(2, 25)]
    assert repeated_lines(pages(spark, [])).collect() == [] and repeated_blocks(pages(spark, [])).collect() == []


def test_long_blocks(spark):
    """A notice of ten lines, its last seven, and single lines of it elsewhere; equal to brute force over all prefixes."""
    rng = random.Random(3)
    notice = [f"line of notice {w}" for w in "a b c d e f g h i j".split()]
    rows = []
    for i in range(40):
        own = lambda: f"own text {''.join(rng.choice('abcdefghij') for _ in range(9))} here"
        cut = [notice, notice[3:], [notice[rng.randrange(10)]], [], notice[:6] + ["x"] + notice[6:]][i % 5]
        rows.append((f"r{i}", ["s"], [(1, own()), (2, "\n".join([own(), *cut, own()])), (3, own())]))
    got = {(r.lines, r.runs) for r in repeated_blocks(pages(spark, rows)).collect()}
    docs = [[x for _, t in b for x in t.split("\n") if len(x.split()) >= 3] for _, _, b in rows]
    runs = {}
    for d, lines in enumerate(docs):
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                runs.setdefault(tuple(lines[i:j]), set()).add(d)
    frequent = {b: len(r) for b, r in runs.items() if len(r) >= 5}
    want = set()
    for lines in docs:
        reach = 0
        for i in range(len(lines)):
            n = max((k for k in range(1, len(lines) - i + 1) if tuple(lines[i : i + k]) in frequent), default=0)
            if n and i + n > reach:
                want.add((n, frequent[tuple(lines[i : i + n])]))
            reach = max(reach, i + n)
    assert got == want and max(n for n, _ in got) == 10
    found = {(r.row_id, r.block_order, r.line_no) for r in repeated_lines(pages(spark, rows), part_bytes=64).collect()}
    assert found == {(i, o, k) for i, (_, _, b) in enumerate(rows, 1) for o, t in b for k, x in enumerate(t.split("\n"), 1) if (x,) in frequent}
