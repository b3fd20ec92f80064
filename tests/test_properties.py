"""Property tests: Spark operators against small pure-Python models."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.operators import words as W

ALPHABET = "mMnNoOpPqQaZx.,'\" \t\n\r\f\u000b é"


def _model(texts):
    c = Counter()
    for t in texts:
        for tok in re.split("[ \t\n\r\f]+", t):
            if tok and tok[0] in "mnopqMNOPQ":
                c[tok] += 1
    return dict(c)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30))
def test_word_count_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.word: r.n for r in W.word_count(W.letter_tokens(df)).collect()}
    assert got == _model(texts)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30))
def test_tally_forms_agree(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    toks = W.letter_tokens(df, keep=["doc_id"])
    a1 = {r.word: r.n for r in W.word_count(toks).collect()}
    a2 = {r.word: r.n for r in W.roll_up_term_frequency(W.doc_term_frequency(toks)).collect()}
    a3 = {r.word: r.n for r in W.word_count_native_tally(toks).collect()}
    assert a1 == a2 == a3


from tests.helpers import flight, flights_df  # noqa: E402
from wayfare.operators import keyed as K  # noqa: E402
from wayfare.operators import monthly as M  # noqa: E402

_row = st.tuples(
    st.sampled_from(["AA", "9E", "WN"]),
    st.integers(min_value=0, max_value=13),  # months 0 and 13 must be dropped
    st.sampled_from([2007, 2008]),
    st.sampled_from([0, 0, 0, 1, 2]),  # flag 2 is kept by the reject rule
    st.floats(min_value=-60, max_value=600, allow_nan=False).map(lambda x: round(x, 2)),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(_row, min_size=1, max_size=60))
def test_monthly_ceiling_matches_model(spark, rows):
    data = [flight(i, "ORD", "LAX", date=(y, 1, 1), year=y, month=m, carrier=c, cancelled=cx,
                   delay=d) for i, (c, m, y, cx, d) in enumerate(rows)]
    got = {(r.carrier, r.month): (r.n, r.avg_delay)
           for r in M.monthly_delay(M.monthly_input(flights_df(spark, data))).collect()}
    groups = {}
    for c, m, y, cx, d in rows:
        if y == 2008 and 1 <= m <= 12 and cx != 1:
            groups.setdefault((c, m), []).append(d)
    assert {k: n for k, (n, _) in got.items()} == {k: len(v) for k, v in groups.items()}
    for k, v in groups.items():
        cents = sum(round(x * 100) for x in v)  # exact
        assert got[k][1] == -(-cents // (100 * len(v)))


_key = st.fixed_dictionaries({
    "year": st.integers(0, 65535), "cancelled": st.integers(0, 255), "month": st.integers(0, 255),
    "carrier_idx": st.integers(0, 255), "l_orderkey": st.integers(0, (1 << 56) - 1),
    "l_linenumber": st.integers(0, 255)})


@settings(max_examples=5, deadline=None)
@given(st.lists(_key, min_size=1, max_size=20))
def test_row_key_bytes_sort_like_tuples(spark, keys):
    cols = [c for c, _ in K.KEY_PARTS]
    df = spark.createDataFrame([tuple(k[c] for c in cols) for k in keys],
                               ", ".join(f"{c} long" for c in cols))
    got = [bytes(r.k) for r in df.select(K.row_key().alias("k")).collect()]
    exp = [K.literal_key(k) for k in keys]
    assert got == exp
    order = sorted(range(len(keys)), key=lambda i: exp[i])
    assert [tuple(keys[i][c] for c in cols) for i in order] == sorted(tuple(k[c] for c in cols) for k in keys)
