import random

import numpy as np
import pytest

from fareloom.llm import licenses


def subsequence(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(2)
    filler = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(200)]
    rows, planted = [], {}
    for i in range(150):
        words = rng.choices(filler, k=rng.randint(0, 120))
        if i % 2:
            name = rng.choice(sorted(licenses.TEMPLATES))
            own = licenses.TEMPLATES[name].split()
            if len(own) > 20 and i % 4 == 1:  # long notices with some words changed
                for at in rng.sample(range(len(own)), len(own) // 12):
                    own[at] = rng.choice(filler)
            at = rng.randint(0, len(words))
            words[at:at] = own
            planted[i] = name
        text = (rng.choice([" ", "\n", " * "])).join(words)
        rows.append((i, text.upper() if i % 5 == 0 else text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return dict(rows), planted, licenses.find_licenses(docs).collect()


def test_every_planted_notice_is_found_and_nothing_else(found):
    texts, planted, rows = found
    assert {r.doc_id for r in rows} == set(planted)
    for i, name in planted.items():
        assert name in {r.template for r in rows if r.doc_id == i}, (i, name)


def test_coverage_and_spans_hold(found):
    texts, _, rows = found
    for r in rows:
        words, spans = licenses._words(texts[r.doc_id].encode())
        template = licenses._words(licenses.TEMPLATES[r.template].encode())[0]
        assert (r.first_byte, r.end_byte) == (spans[r.first_word][0], spans[r.end_word - 1][1])
        assert 0.8 <= r.coverage == r.matched_words / len(template)
        assert r.matched_words <= subsequence(template, words[r.first_word:r.end_word])
    for r in rows:
        assert not [o for o in rows if o.doc_id == r.doc_id and o != r and o.first_word < r.end_word and r.first_word < o.end_word]


def test_fingerprints_hold_every_run_of_four_words():
    rng = random.Random(1)
    for _ in range(50):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(4, 40))]
        at = rng.randint(0, len(words) - 4)
        chosen = licenses.winnow(licenses._grams(words, {}))
        assert any(at <= p <= at + 1 for p in chosen)
        assert np.array_equal(licenses._grams(words[at:], {}), licenses._grams(words, {})[at:])


def test_odd_rows(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(None, mit), (1, None), (1, ""), (2, mit + " " + mit), (2, mit + " " + mit), (3, "x " * 200_000 + mit), (4, "MIT License")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, template string")
    got = sorted((r.doc_id or 0, r.template, r.first_word) for r in licenses.find_licenses(docs).collect())
    assert got == [(0, "MIT", 0), (2, "MIT", 0), (2, "MIT", 0), (2, "MIT", 5), (2, "MIT", 5), (3, "MIT", 200_000)]
    assert licenses.find_licenses(docs.limit(0)).collect() == []
    assert licenses.find_licenses(docs, {}).collect() == []
    assert licenses.find_licenses(docs, {"two": "MIT License", "none": ""}).collect() == []


def test_every_one_edit_variant_of_short_notices_is_found():
    index, known = licenses.TemplateIndex(licenses.TEMPLATES), {}
    for name, notice in licenses.TEMPLATES.items():
        words = licenses._words(notice.encode())[0]
        if not 5 <= len(words) <= 15:
            continue
        for at in range(len(words)):
            for put in ([], [b"zzz"], [words[at], b"zzz"]):
                text = b"some text " + b" ".join(words[:at] + put + words[at + 1:]) + b" and more"
                plain = licenses.align(words, licenses._words(text)[0], -99, 99)
                assert plain[0] >= 0.8 * len(words)
                # Another notice may fit the variant better (version 2 and 3, BY and BY-SA).
                assert any(name == n or m[2] >= plain[0] for m in index.find(text, 0.8, known) for n in m[:1]), (name, text)
    for text in (b"Released under MIT License", b"Released under an MIT License"):
        assert [m[0] for m in index.find(text, 0.8, known)] == ["MIT"]


def test_tags_name_their_own_license_only(spark):
    rows = [(i, f"/* x */\n// SPDX-License-Identifier: {n}\nint main") for i, n in enumerate(licenses.IDENTIFIERS)]
    rows += [(900, "SPDX-License-Identifier: Foo-2.0-only"), (901, "SPDX-License-Identifier: GPL-4.0-only"), (902, "spdx license mit"),
             (903, "SPDX-License-Identifier: Apache-9 OR none of 2 0"), (904, "# SPDX-License-Identifier: MIT OR Apache-2.0")]
    got = {(r.doc_id, r.template, r.coverage) for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(i, f"SPDX:{n}", 1.0) for i, n in enumerate(licenses.IDENTIFIERS)} | {(904, "SPDX:MIT", 1.0)}
    own = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), tags={"foo": "SPDX-License-Identifier: Foo-2.0"})
    assert [(r.doc_id, r.template) for r in own.collect()] == [(900, "foo")]


def test_titles_of_license_texts():
    index, known = licenses.TemplateIndex(licenses.TEMPLATES, 0.8, licenses.TAGS), {}
    for text, name in (
            (b"                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989", "GPL-2.0-title"),
            (b"GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0-title"),
            (b"GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n", "LGPL-3.0-title"),
            (b"GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007\n\n", "AGPL-3.0-title"),
            (b"Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, "
             b"REPRODUCTION, AND DISTRIBUTION\n\n 1. Definitions.", "Apache-2.0-title"),
            (b"Mozilla Public License Version 2.0\n====\n\n1. Definitions", "MPL-2.0-title")):
        assert [m[0] for m in index.find(text, 0.8, known)] == [name]
