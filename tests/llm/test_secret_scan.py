import random
import re
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeguard.llm import secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SCHEMA = "doc_id long, text string, source string, base string"


def brute(text):
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def base(rows, texts):
    table = rows([(i, t, "s", None) for i, t in enumerate(texts)], SCHEMA)
    out = secret_scan.find_secrets(table).select("doc_id", secret_scan.span_text(F.col("base")).alias("s"))
    return [r.s for r in sorted(out.collect(), key=lambda r: r.doc_id)]


HEX = "0123456789abcdef" * 2
PARTS = ["password", "TOKEN", "api_key", "apikey", "secret", '"', "'", " ", "  ", ":", "=", "abc", "abcdef1", "é😀", "AKIA", "ABCDEFGHIJ123456", HEX, "\n", "x" * 7]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), min_size=20, max_size=40))
def test_base_spans_are_those_of_the_patterns(rows, texts):
    assert base(rows, texts) == [brute(t) for t in texts]


def test_dropped_match_is_not_searched_again(rows):
    text = "secret=token:abcdefgh secret: pass"
    assert base(rows, [text]) == [brute(text)] == [""]


def test_null_empty_and_long(rows):
    long = "token=abcdef " * 3000
    assert base(rows, [None, "", long]) == ["", "", brute(long)]
    assert secret_scan.find_secrets(rows([], SCHEMA)).count() == 0


def test_owners_separate_examples_from_live_values(rows):
    key, sample = "Zx9kQ27LmPw4RtY8", "Ab12Cd34Ef56Gh78Jk90"
    table = rows(
        [(1, f"token = {key}", "one", None), (2, f"see {key}{key[:4]} and {key}", "one", None)]
        + [(10 + i, f"token = {sample}", f"owner{i}", None) for i in range(5)]
        + [(20, f"bare {sample}", "owner1", None), (30, "token = Zx9kQ27LmPw4RtY8aaaaB", "one", None), (31, "in Zx9kQ27LmPw4RtY8aaaaB", "one", None),
           (32, "in Zx9kQ27LmPw4RtY8aaaaB", "two", None)],
        SCHEMA,
    )
    out = {r.doc_id: r for r in secret_scan.find_secrets(table).collect()}
    assert (out[1].n_live, out[1].n_shared) == (1, 0)
    assert (out[10].n_live, out[10].n_shared) == (0, 1)
    assert out[2].bare == [] and out[20].bare == []
    assert [(s.start, s.end) for s in out[31].bare] == [(3, 24)]
    assert out[32].bare == []  # another owner


def test_repeated_rows_and_null_owner(rows):
    out = secret_scan.find_secrets(rows([(1, "token=abcdef", None, None)] * 2 + [(None, "x", None, None)], SCHEMA))
    assert sorted(len(r.base) for r in out.collect()) == [0, 1, 1]


def test_fifty_thousand_matches_in_one_text(rows):
    rng = random.Random(12)
    parts = [(rng.choice(["é ", "x=", "\n"]), "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(20, 40)))) for _ in range(50_000)]
    text = "".join(gap + word for gap, word in parts)
    began = time.monotonic()
    (row,) = rows([(text,)], "text string").select(secret_scan.base_spans(F.col("text")).alias("spans")).collect()
    assert time.monotonic() - began < 60
    want = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    assert [(s.start, s.end) for s in row.spans if s.kind == "hex"] == want and len(want) > 35_000
