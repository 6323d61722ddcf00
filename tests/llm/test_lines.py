import random
import re
import struct

import pytest
import xxhash

from fareloom.llm import lines


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)) + "."


def pieces(text):
    return [p for p in re.split(r"(?<=\n)|(?<=[.!?] )", text)]


def bare(p):
    return p.strip(" \t\r\n")


def words(p):
    return bare(p).count(" ") + 1 if bare(p) else 0


def hashed(*values):
    """Spark's xxhash64 of texts and of longs."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def chosen(ps):
    """Places and hashes of the fingerprints of a list of lines."""
    h, grams = [hashed(p) for p in ps], []
    for i in range(len(ps)):
        long = words(ps[i]) >= lines.LONG_LINE
        grams.append(hashed(h[i]) if long else hashed(*h[i:i + 3]) if i + 2 < len(ps) else None)
    least = [min((g for g in grams[i:i + 3] if g is not None), default=None) for i in range(len(ps))]
    return [(i, g) for i, g in enumerate(grams) if g is not None and (
        words(ps[i]) >= lines.LONG_LINE or g in least[max(0, i - 2):i + 1])]


def brute(rows, min_words):
    """The places that go: links near repeated fingerprints that have any earlier place, in runs of enough words."""
    docs = sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1])))
    split = {d: [bare(p) for p in pieces(d[1])] for d in docs}
    picked = {d: chosen(split[d]) for d in docs}
    times = {}
    for i, t in rows:
        for _, g in picked[i, t] if t else ():
            times[g] = times.get(g, 0) + 1
    seen, out = set(), {}
    for d in docs:
        ps, marked = split[d], set()
        near = {k for p, g in picked[d] if times[g] > 1 for k in range(max(0, p - 3), min(len(ps), p + 5))}
        for i in sorted(near):
            for link in ([tuple(ps[i:i + 2])] if i + 1 < len(ps) else []) + (
                    [(ps[i],)] if words(ps[i]) >= lines.LONG_LINE else []):
                if link in seen:
                    marked.update(range(i, i + len(link)))
                seen.add(link)
        gone, run = set(), []
        for i in range(len(ps) + 1):
            if i in marked:
                run.append(i)
            else:
                if sum(words(ps[k]) for k in run) >= min_words:
                    gone.update(run)
                run = []
        out[d] = gone
    return out


def holds(text, passage):
    ps, n = [bare(p) for p in pieces(text or "")], len(passage)
    return any(ps[i:i + n] == passage for i in range(len(ps)))


def cut(text, gone):
    """What stays of ``text`` if the places in ``gone`` go."""
    return "".join(p for i, p in enumerate(pieces(text)) if i not in gone)


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[sentence(rng, rng.randint(3, 20)) for _ in range(rng.randint(2, 9))] for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [sentence(rng, rng.randint(1, 15)) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.choice(passages)
        if rng.random() < 0.3:
            parts.insert(rng.randint(0, len(parts)), "Short one.")
        rows.append((i, "".join(p + rng.choice([" ", "\n", "\n\n"]) for p in parts).strip(" ")))
    rows += [(90, rows[5][1]), (None, rows[6][1]), (91, "a b. " * 200), (92, None), (93, ""), (94, "\n\n\n"), rows[8]]
    want = brute(rows, 25)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, removed_lines int, d string")
    out = lines.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "d", "removed_lines", "removed_words"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        originals = [t for i, t in rows if i == r.doc_id]
        if not originals[0]:
            assert r.text == originals[0] and r.removed_lines == 0
            continue
        gone = want[r.doc_id, originals[0]]
        assert (r.text, r.removed_lines) == (cut(originals[0], gone), len(gone))
    for passage in passages:
        if sum(map(words, passage)) > 50:
            assert len({r.doc_id for r in got if holds(r.text, passage)}) <= 1
    assert sum(r.removed_lines > 0 for r in got) > 10


def test_a_passage_inside_paragraphs_goes_from_all_but_the_first(spark):
    rng = random.Random(7)
    passage = " ".join(sentence(rng, 10) for _ in range(6))
    rows = [(i, f"{sentence(rng, 20)} {passage} {sentence(rng, 8)}\n{sentence(rng, 30)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert got[0].text == rows[0][1]
    assert all(got[i].text == rows[i][1].replace(passage + " ", "") and got[i].removed_words == 60 for i in range(1, 300))


def test_a_passage_whose_beginning_is_older_than_the_rest_goes_whole(spark):
    """a holds X, b holds X + Y, and each c repeats X + Y: whatever grams are chosen, c loses all of its lines."""
    rng, rows, n = random.Random(9), [], 300
    for i in range(n):
        x, y = [sentence(rng, 11) for _ in range(3)], [sentence(rng, 11) for _ in range(2)]
        rows += [(i, " ".join(x) + " " + sentence(rng, 9)), (n + i, " ".join(x + y)),
                 (2 * n + i, " ".join([sentence(rng, 9), *x, *y]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert all(got[i].removed_lines == 0 for i in range(n))
    assert all(got[2 * n + i].removed_words == 55 for i in range(n))


def test_one_very_long_line_and_whole_copies(spark):
    rng = random.Random(8)
    line = sentence(rng, 5000)
    docs = spark.createDataFrame([(1, "One here. " + line), (2, line), (3, "Clean text stays as it is.")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert got == {1: "One here. " + line, 2: "", 3: "Clean text stays as it is."}


def test_an_empty_table_stays_empty(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
