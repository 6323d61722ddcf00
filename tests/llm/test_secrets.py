import random
import re

import pytest
from pyspark.sql import functions as F

from fareloom.llm import secrets


def corpus(rng, n):
    """Texts with secrets, numbers, names with digits and paths; the label of each by (document, word)."""
    words = ["".join(rng.choices("aeinorst", k=rng.randint(3, 8))) for _ in range(80)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 40))
        kind = i % 4
        if kind == 0:
            text += [rng.choice(["token", "api_key", "password"]), rng.choice(["=", ":"]),
                     '"' + "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40]))) + '"']
        elif kind == 1:
            text.append("".join(rng.choices("0123456789", k=16)))
        elif kind == 2:
            text.append("".join(rng.choices(words, k=3)) + "2024")
        if kind < 3 and len(text[-1].strip('"')) >= 12:
            labels.append((i, len(text) - 1, int(kind == 0)))
        rows.append((i, " ".join(text + ["end"]), f"src/{i % 3}/test" if kind == 2 else "src/main"))
    return rows, labels


def test_false_findings_are_removed(spark):
    rows, labels = corpus(random.Random(1), 600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    train = spark.createDataFrame([r for r in labels if r[0] < 300] + [(1, 1, None)], "doc_id long, word int, label int")
    got = {(r.doc_id, r.word): r for r in secrets.find_secrets(docs, train, path_col="path").collect()}
    assert set(got) == {(i, w) for i, w, _ in labels}
    held = [(got[i, w].secret, bool(label)) for i, w, label in labels if i >= 300]
    assert sum(a == b for a, b in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.secret == (r.score >= 0.5) for r in got.values())


def test_features_against_plain_python(spark):
    text = 'my secret = "Abc123-XYZ789=="; then path/to1/file2name'
    docs = spark.createDataFrame([(1, text, "a/tests/b")], "doc_id long, text string, path string")
    rows = {r.finding: r for r in secrets.with_features(secrets.candidates(docs, path_col="path"), ["then", "file"]).collect()}
    r = rows["Abc123-XYZ789=="]
    s = r.finding

    def kind(c):
        return "d" if c.isdigit() else "l" if c.isalpha() else "s"
    assert r.length == len(s) and r.digits == sum(map(str.isdigit, s)) / len(s)
    assert r.capitals == sum(map(str.isupper, s)) / len(s) and r.hex == len(re.findall("[0-9a-fA-F]", s)) / len(s)
    assert r.signs == 3 / len(s) and r.distinct == len(set(s)) / len(s)
    assert r.changes == sum(kind(a) != kind(b) for a, b in zip(s, s[1:])) / len(s)
    assert (r.quoted, r.assigned, r.named, r.path_depth, r.path_sample) == (1, 1, 1, 2, 1)
    other = rows["path/to1/file2name"]
    assert (other.word, other.covered, other.word_before, other.quoted, other.assigned) == (5, 4 / 18, 1, 0, 0)


def test_every_run_of_a_word_is_a_candidate(spark):
    many = "{" + ",".join(f'"k{i}":"{i:016x}"' for i in range(2000)) + "}"
    texts = ['{"client_secret":"9f86d081884c7d659a2feaa0c55ad015"}', '"authorization":"Bearer0123456789abcdef"',
             '{"id":"a1b2c3d4e5f60718","token":"24be64a1b2c3d4e5"}', 'password="correcthorsebattery"',
             'password = "correcthorsebattery"', "an internationalization ------------ key: ============", many]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.candidates(docs)
    got = sorted((r.doc_id, r.word, r.part, r.finding) for r in found.where("doc_id < 6").collect())
    assert got == [(0, 0, 1, "9f86d081884c7d659a2feaa0c55ad015"), (1, 0, 1, "Bearer0123456789abcdef"),
                   (2, 0, 0, "a1b2c3d4e5f60718"), (2, 0, 1, "24be64a1b2c3d4e5"), (3, 0, 0, "correcthorsebattery"),
                   (4, 2, 0, "correcthorsebattery")]
    assert sorted(r.finding for r in found.where("doc_id = 6").collect()) == sorted(f"{i:016x}" for i in range(2000))
    seen = {(r.doc_id, r.part): (r.named, r.assigned, r.quoted) for r in secrets.with_features(found, []).where("doc_id < 3").collect()}
    assert seen == {(0, 1): (1, 1, 1), (1, 1): (1, 1, 1), (2, 0): (0, 1, 1), (2, 1): (1, 1, 1)}
    labels = spark.createDataFrame([(2, 0, 0, 0), (2, 0, 1, 1)], "doc_id long, word int, part int, label int")
    out = secrets.find_secrets(docs, labels).where("doc_id = 2").collect()
    assert {(r.part, r.finding) for r in out} == {(0, "a1b2c3d4e5f60718"), (1, "24be64a1b2c3d4e5")}


def test_odd_rows(spark):
    long = "w " * 100_000 + "0123456789abcdef"
    rows = [(None, 'key: "0123456789abcdef"', 1), (1, None, 1), (1, "", 1), (2, "   ", 1), (3, "0123456789abcdef", None),
            (3, "0123456789abcdef", None), (4, long, 1), (5, "short1 nodigitsherelong 12345678901.2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, word int, label int")
    got = sorted((r.doc_id or 0, r.word, r.finding, r.score, r.secret) for r in secrets.find_secrets(docs, none).collect())
    assert got == [(0, 1, "0123456789abcdef", 1.0, True), (3, 0, "0123456789abcdef", 1.0, True),
                   (3, 0, "0123456789abcdef", 1.0, True), (4, 100_000, "0123456789abcdef", 1.0, True)]
    assert secrets.find_secrets(docs.limit(0), none).collect() == []


@pytest.mark.parametrize("limit", [40])
def test_the_sample_is_bounded(spark, limit):
    rows, labels = corpus(random.Random(2), 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = secrets.find_secrets(docs, F.col("before").rlike("(token|key|password) [=:]$"), max_rows=limit).collect()
    truth = {(i, w): bool(label) for i, w, label in labels}
    assert sum(r.secret == truth[r.doc_id, r.word] for r in got) / len(got) > 0.9


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, 'token = "0123456789abcdef"')], "doc_id long, text string")
    plan = secrets.find_secrets(docs, F.lit(1))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_a_key_is_found_however_it_is_written(spark):
    """Three ways to write an assignment, keys without a name, and what looks like keys but is none."""
    rng = random.Random(7)

    def key(n=32):
        return "".join(rng.choices("0123456789abcdef", k=n))
    forms = {"word": lambda: f"token: {key()}", "equals": lambda: f"password={key(18)}", "json": lambda: '{"client_secret":"%s"}' % key(),
             "access": lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
             "build": lambda: f"build_id={key()}", "commit": lambda: f"commit: {key(40)}", "bare": lambda: key(40),
             "card": lambda: "".join(rng.choices("0123456789", k=16)), "json id": lambda: '{"id":"%s"}' % key()}
    words = ["".join(rng.choices("aeinorst", k=rng.randint(3, 8))) for _ in range(80)]
    rows = [(i, form, " ".join([*rng.choices(words, k=6), make(), *rng.choices(words, k=6)]))
            for form, make in forms.items() for i in range(len(forms) * 100) if i % len(forms) == list(forms).index(form)]
    docs = spark.createDataFrame(rows, "doc_id long, form string, text string")
    flagged = {form: 0 for form in forms}
    for r in secrets.find_secrets(docs, secrets.labels_by_form()).collect():
        flagged[list(forms)[r.doc_id % len(forms)]] += r.secret
    assert all(flagged[f] >= 95 for f in ("word", "equals", "json", "access"))
    assert all(flagged[f] <= 5 for f in ("build", "commit", "bare", "card", "json id"))


def test_the_query_over_the_test_table(spark):
    """Every planted form of the table is flagged, whatever the forest saw of it; long numbers are not."""
    from fareloom.llm import queries
    folder = "/root/testdata/sf0.01"  # a forest needs some dozens of findings
    out = queries.QUERIES["op10_secret_scan"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    keys = {(i, m) for i, t in texts.items() for m in re.findall(r"(?:token = \"|password=)([0-9a-f]{16,})", t)}
    found = {(r.doc_id, r.finding): r.secret for r in out}
    assert keys <= found.keys() and all(found[k] for k in keys)
    assert not any(secret for (_, f), secret in found.items() if f.isdigit())


def test_labels_and_held_out_precision(spark):
    """Learnt from four fifths of the documents, judged on the rest: the label is not a feature written again."""
    from fareloom.catalog.mapping import table
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text", "source")
    found = secrets.candidates(docs, path_col="source").withColumn("label", secrets.labels_by_form()).where("label is not null")
    train = found.where("doc_id % 5 != 0").select("doc_id", "word", "part", "label")
    got = {(r.doc_id, r.word, r.part): r.secret for r in secrets.find_secrets(docs, train, path_col="source").collect()}
    held = [(got[r.doc_id, r.word, r.part], bool(r.label)) for r in found.where("doc_id % 5 = 0").collect()]
    hits = sum(a and b for a, b in held)
    print("held out", len(held), "precision", hits / sum(a for a, _ in held), "recall", hits / sum(b for _, b in held))
    assert hits / sum(a for a, _ in held) >= 0.9 and hits / sum(b for _, b in held) >= 0.9
