"""Which lines op10's stage fetches."""

from ledgerleaf.llm import lines


def test_only_lines_that_may_have_a_partner_are_sent(monkeypatch, spark):
    texts = [f"a line {k} of its own, {'xyzuvw'[k % 6] * (k + 5)} and no other\nshort\nthe same line with one edit {'ab'[k % 2]} somewhere" for k in range(20)]
    docs = spark.createDataFrame([*enumerate(texts), (20, None), (21, "")], "doc_id long, text string")
    meeting = lines._meeting_keys(docs, lines.EDITS, lines.LEAST_BYTES).distinct()
    sent = lines._line_texts(docs, lines.LEAST_BYTES, lines._sieve(meeting, lines.SIEVE)).collect()
    met = {r.h for r in meeting.collect()}
    hashes = {t: int(lines.Rolling(lines.np.frombuffer(t.encode(), lines.np.uint8)).hashes(lines.np.array([0]), lines.np.array([len(t)])).view("i8")[0]) >> 1 for x in texts for t in x.split("\n")}
    assert {(r.doc, r.line, bytes(r.raw).decode()) for r in sent} == {
        (k, n, t) for k, x in enumerate(texts) for n, t in enumerate(x.split("\n")) if len(t) >= lines.LEAST_BYTES and hashes[t] in met
    }
    assert any(r.line == 2 for r in sent) and len(sent) < 40
    # What a coarse sieve lets through changes no result.
    fine = sorted(map(tuple, lines.line_report(docs).collect()))
    assert sum(r[3] for r in fine) == 19 and sum(r[4] for r in fine) == 1
    monkeypatch.setattr(lines, "SIEVE", 64)
    assert sorted(map(tuple, lines.line_report(docs).collect())) == fine
