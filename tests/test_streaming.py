"""The word job over a stream of text files equals the batch job."""

from wayfare.operators.words import letter_tokens, word_count
from wayfare.streaming import start_word_count


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("Of of many\nnone  pq\n")
    (src / "b.txt").write_text("\tmany more Quick quick\n")
    q = start_word_count(spark, str(src), name="wc_stream_test",
                         checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = {r.word: r.n for r in spark.sql("SELECT * FROM wc_stream_test").collect()}
    batch = word_count(letter_tokens(spark.read.text(str(src)), text_col="value"))
    assert got == {r.word: r.n for r in batch.collect()}
    assert got["many"] == 2 and got["Of"] == 1 and got["of"] == 1


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("many more\n")
    ckpt = str(tmp_path / "ckpt")
    q = start_word_count(spark, str(src), name="wc_resume", sink="memory", checkpoint=ckpt)
    q.awaitTermination(120)
    (src / "b.txt").write_text("many\n")
    q = start_word_count(spark, str(src), name="wc_resume2", sink="memory", checkpoint=ckpt)
    q.awaitTermination(120)
    got = {r.word: r.n for r in spark.sql("SELECT * FROM wc_resume2").collect()}
    assert got == {"many": 2, "more": 1}  # state carried over; a.txt not re-read
