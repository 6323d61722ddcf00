import hashlib
import random

import pytest

from fareloom.llm import queries, signatures
from conftest import SF_DIR

SCHEMA = "doc_id long, text string, range int, extra string, k1 double"


def plain(text):
    """The signature by lists: every k-mer with its occurrence number, the least ones by rank, in the order of the text."""
    if not text:
        return "0" * 256
    kmers = signatures.numbered_kmers(text).tolist()
    out = ""
    for add, times in zip(signatures._ADD[:, 0].tolist(), signatures._TIMES[:, 0].tolist()):
        ranked = sorted(range(len(kmers)), key=lambda i: ((((kmers[i] >> 32) ^ add) * times) % (1 << 32), i))
        code = 0
        for i in sorted(ranked[:signatures.PICKED]):
            code = int(signatures._mix(signatures.np.array([(code * 31 + kmers[i]) % (1 << 64)], "u8"))[0])
        out += f"{code >> 48:04x}"
    return out


def words(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("text", ["", "a", "ab é🙂", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", words(1, 30), words(2, 1500), "ab " * 900])
def test_signature_is_that_of_a_plain_version(text):
    assert signatures.signature(text) == plain(text)


def test_occurrences_are_numbered():
    one, two = signatures.numbered_kmers("abcdefgh" * 3), signatures.numbered_kmers("abcdefgh" * 2)
    assert len(set(one.tolist())) == len(one) and one[:9].tolist() == two.tolist()


def test_order_and_edits_lower_the_likeness():
    a, b = words(3, 200), words(4, 200)
    own = signatures.signature(a + " " + b)
    assert signatures.likeness(own, own) == 1
    edited = signatures.likeness(own, signatures.signature((a + " " + b).replace("ab", "zz", 4)))
    moved = signatures.likeness(own, signatures.signature(b + " " + a))
    assert edited > 0.7 and 0.2 < moved < edited  # MinHash without order would find nearly no difference after the move
    assert signatures.likeness(own, signatures.signature(words(5, 400))) < 0.1
    assert signatures.likeness("0" * 256, own) == 0 and signatures.likeness("0" * 256, "0" * 256) == 1


def wanted(data):
    """Unique ids: rows by descending id, those without one last."""
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        own, changed, following = map(signatures.signature, (text, edited, after))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed,
                    signatures.likeness(own, changed), signatures.likeness(own, following)))
    return sorted(out, key=repr)


def frame(spark, data):
    return spark.createDataFrame([(k, t, 1, "x", 0.1) for k, t in data], SCHEMA).repartition(3)


def test_every_row_meets_its_next_one(spark, rows):
    data = [(i * 3 - 70, words(i, 1 + i % 40)) for i in range(90)]
    data += [(5000, None), (5001, ""), (5002, "x" * 300_000), (5003, words(1, 3)), (-(1 << 63), "least"), ((1 << 63) - 1, "most"), (None, "no id")]
    assert rows(signatures.fingerprint_with_next(frame(spark, data))) == wanted(data)


def test_one_row_no_row_and_repeated_rows(spark, rows):
    assert rows(signatures.fingerprint_with_next(frame(spark, [(4, "abcdefghijkl")]))) == wanted([(4, "abcdefghijkl")])
    assert signatures.fingerprint_with_next(frame(spark, [])).count() == 0
    same = [(i % 2, "one text, many rows") for i in range(400)] + [(None, "one text, many rows")] * 50
    found = signatures.fingerprint_with_next(frame(spark, same)).collect()
    assert len(found) == 450 and {r.near_next for r in found} == {1.0} and len({r.fingerprint for r in found}) == 1
    mixed = [(1, t) for t in "abcdefgh"] * 3  # one id: by hash, copies together
    found = signatures.fingerprint_with_next(frame(spark, mixed)).collect()
    assert len(found) == 24 and sum(r.near_next == 1 for r in found) == 16


def test_query_over_the_test_table(spark, rows):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.QUERIES["op13_document_fingerprints"](spark, SF_DIR)) == wanted(data)


def test_signatures_of_a_column(spark):
    texts = ["", None, words(1, 50)]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(signatures.signatures("t")).collect()]
    assert got == [signatures.signature(t or "") for t in texts]
