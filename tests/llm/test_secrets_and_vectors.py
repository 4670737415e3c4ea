"""Secret scans, centroid clustering and vector codes against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldspine.llm import centroids, part_codes, secret_scan
from tests.llm import cases

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def signed(prefix, body):
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        digits = _BASE62[digit] + digits
    return prefix + body + digits


def plain_spans(text):
    """Every pattern over the whole text."""
    text, found = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for k, kind, pattern in ((3, "github", "(gh[pousr]_)([0-9A-Za-z]+)"), (4, "npm", "(npm_)([0-9A-Za-z]+)")):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[2]) == 36 and m[0] == signed(m[1], m[2][:30])]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def credentials(seed, n):
    draw = random.Random(seed)
    some = lambda alphabet, low, high: "".join(draw.choice(alphabet) for _ in range(draw.randrange(low, high)))
    pieces = [
        lambda: draw.choice(["password", "PassWD", "secret", "TOKEN", "api_key", "ApiKey", "passwordtoken"]) + draw.choice(["", '"', "' "])
        + draw.choice([" = ", ":", "=", "==", " "]) + draw.choice(["", "'", '"']) + some(_BASE62 + "+/_.=-", 1, 14),
        lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 10, 24), lambda: some("0123456789abcdef", 18, 60),
        lambda: some("0123456789ABCDEFabcdef", 20, 60), lambda: signed(draw.choice(["ghp_", "ghs_"]), some(_BASE62, 30, 31)),
        lambda: signed("npm_", some(_BASE62, 30, 31)), lambda: "gho_" + some(_BASE62, 36, 37), lambda: draw.choice(["é", "😀", "ſecret=abcdefgh", "toKen:abcdefgh", "\n", "akia"]),
    ]
    return [draw.choice(["", " ", ", "]).join(draw.choice(pieces)() for _ in range(draw.randrange(1, 12))) for _ in range(n)]


def test_secrets_equal_whole_pattern_search(spark):
    texts = list(enumerate([None, "", "a" * 5000 + "Z" + "b" * 23, "ABC" + "0" * 24, "secret=token:abcdefgh", *credentials(3, 300)]))
    texts += [(None, "token = abcdef"), texts[9], (9, "password: other1")]
    found = secret_scan.summary(cases.frame(spark, texts)).collect()
    expected = []
    for i, text in texts:
        spans = plain_spans(text)
        base = [s for s in spans if s.split(":")[0] in secret_scan.BASE]
        n = [sum(s.startswith(f"{k}:") for s in spans) for k in secret_scan.BASE]
        expected.append((i, *n, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(spans)))
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert {"github", "npm"} <= {s.split(":")[0] for r in expected for s in r[5].split(",")}
    assert secret_scan.summary(cases.frame(spark, texts).limit(0)).count() == 0


def test_masked_texts(spark):
    token = signed("ghp_", "A1" * 15)
    docs = spark.createDataFrame(
        [(1, f"é {token} token='{'0' * 30}' end", "x"), (2, None, "y"), (2, "clean", None)], "doc_id long, text string, `spans.x` string"
    )
    got = {(r[0], r[1], r[2]) for r in secret_scan.masked(docs).collect()}
    assert got == {(1, "é [github] [assign]' end", "x"), (2, "", "y"), (2, "clean", None)}


def test_a_long_text_is_scanned_whole(spark):
    text = "x y " * 5_000_000
    docs = spark.createDataFrame([(1, 0)], "doc_id long, n int").select("doc_id", F.concat(F.repeat(F.lit("x y "), F.lit(5_000_000)), F.lit("AKIA" + "B" * 16)).alias("text"))
    assert secret_scan.summary(docs).first().spans == f"access:{len(text)}:{len(text) + 20}"


def test_keywords_must_not_lie_inside_each_other():
    with pytest.raises(ValueError):
        secret_scan.Rule("k", ("token", "tokens"), "tokens?", lambda m: True)


def vectors(seed, n, dims=64):
    """Clumps, copies, ties, and vectors that do not count."""
    draw = random.Random(seed)
    centers = [[draw.uniform(-0.6, 0.6) for _ in range(dims)] for _ in range(9)]
    rows = []
    for i in range(n):
        center = centers[draw.randrange(9) if i % 3 else 0]
        rows.append((7 * i % 1009 + i // 1009 * 1009, [float(np.float32(c + draw.gauss(0, 0.05))) for c in center], draw.choice([None, 1, 2, 2, 2])))
    rows += [(5000 + i, rows[4][1], 1) for i in range(n // 3)]  # one vector a quarter of all
    rows += [rows[8], (None, rows[10][1], 3), (-4, [0.0] * dims, None), (-3, [0.5] * dims, 2)]
    odd = [(9000, None, 1), (9001, [], 1), (9002, [0.1] * (dims - 1), 1), (9003, [0.1] * (dims + 16), 2)]
    for i, bad in enumerate((None, math.nan, math.inf, -math.inf)):
        odd.append((9010 + i, [0.1] * (dims - 1) + [bad], 1))
    return rows, odd


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, _id string, _values string, cluster string, `c.label` int"
    return spark.createDataFrame([(*r, "i", "v", "c", 0) for r in rows], schema).repartition(5)


def nearest(x, entries):
    d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries]
    return d.index(min(d)), min(d)


def means(xs, labels, entries):
    out = []
    for k, old in enumerate(entries):
        mine = [x for x, c in zip(xs, labels) if c == k]
        out.append([sum(column) // len(mine) for column in zip(*mine)] if mine else old)
    return out


def test_clusters_equal_plain_lloyd(spark):
    rows, odd = vectors(5, 150)
    kept = [(i, [math.floor(64 * v) for v in x]) for i, x, _ in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], np.int32).tobytes()))
    held = [x for _, x in order[:16]]
    for _ in range(3):
        held = means([x for _, x in kept], [nearest(x, held)[0] for _, x in kept], held)
    last = [(i, *nearest(x, held)) for i, x in kept]
    inertia = {c: sum(d for _, k, d in last if k == c) for c in range(16)}
    expected = [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, held[c])).encode()).hexdigest()) for i, c, d in last]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(tuple, centroids.summary(frame(spark, rows + odd)).collect()), key=key) == sorted(expected, key=key)


def test_clusters_of_few_vectors_and_none(spark):
    rows, odd = vectors(6, 12)
    few = centroids.summary(frame(spark, rows[:3] + odd)).collect()
    assert [r.distance for r in few] == [0, 0, 0] and len({r.cluster for r in few}) == 3
    for none in (frame(spark, odd), frame(spark, rows).limit(0)):
        assert centroids.summary(none).count() == 0


def test_tables_sum_to_distances():
    draw = np.random.default_rng(2)
    x, c = draw.integers(-70, 70, (500, 12)).astype(np.int32), draw.integers(-70, 70, (5, 12))
    assert (centroids.distances(x, c) == ((x[:, None].astype(np.int64) - c) ** 2).sum(2)).all()


def test_codes_equal_plain_search(spark):
    rows, odd = vectors(7, 120)
    label = {}
    kept = [(i, [math.floor(256 * v) for v in x], l) for i, x, l in rows]
    order = sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], np.int32).tobytes()))
    cut = lambda x: [x[4 * p : 4 * p + 4] for p in range(16)]
    books = [[cut(x)[p] for _, x, _ in order[:64]] for p in range(16)]
    for _ in range(2):
        for p in range(16):
            xs = [cut(x)[p] for _, x, _ in kept]
            books[p] = means(xs, [nearest(x, books[p])[0] for x in xs], books[p])
    expected, written = [], ",".join(str(v) for b in books for e in b for v in e)
    for i, x, l in kept:
        found = [nearest(x, b) for x, b in zip(cut(x), books)]
        error = sum(d for _, d in found)
        label[l] = label.get(l, 0) + error
        expected.append((i, "".join(f"{e:02x}" for e, _ in found), error, l))
    digest = hashlib.sha256(written.encode()).hexdigest()
    expected = [(i, code, error, label[l], digest) for i, code, error, l in expected]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(tuple, part_codes.summary(frame(spark, rows + odd)).collect()), key=key) == sorted(expected, key=key)


def test_codes_of_few_vectors_and_none(spark):
    rows, odd = vectors(8, 12)
    few = frame(spark, rows[:5] + odd)
    codes, books = part_codes.compress(few)
    assert books.shape == (16, 5, 4) and {r.error for r in codes.collect()} == {0}
    back = {r._id: r.vector for r in part_codes.restored(codes, books).collect()}
    assert back == {i: [math.floor(256 * v) / 256 for v in x] for i, x, _ in rows[:5]}
    for none in (frame(spark, odd[:3]), frame(spark, rows).limit(0)):
        assert part_codes.summary(none).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_rings_hold_the_nearest_entry(seed):
    """Any assignment, radii that hold it, ties on a coarse grid: rings and cores give what a full search gives."""
    draw = np.random.default_rng(seed)
    entries, x = draw.integers(-4, 5, (30, 3)), draw.integers(-4, 5, (700, 3))
    full = ((x[:, None] - entries) ** 2).sum(2)
    own = draw.integers(0, 30, 700)
    radii = np.zeros(30, np.int64)
    np.maximum.at(radii, own, np.ceil(np.sqrt(full[np.arange(700), own])).astype(np.int64))
    held = part_codes.balls(entries, radii, np.zeros(30, bool))
    got, distance = part_codes.reassigned(x, own, held)
    assert (got == full.argmin(1)).all() and (distance == full.min(1)).all()
    # Entries that stood still were beaten already.
    moved = entries.copy()
    moved[::4] += draw.integers(-1, 2, moved[::4].shape)
    still = (moved == entries).all(1)
    after = ((x[:, None] - moved) ** 2).sum(2)
    radii = np.zeros(30, np.int64)
    np.maximum.at(radii, got, np.ceil(np.sqrt(after[np.arange(700), got])).astype(np.int64))
    held = part_codes.balls(moved, radii, still)
    again, _ = part_codes.reassigned(x, got, held)
    assert (again == after.argmin(1)).all() and len(held.neighbours) < 30 * 29
