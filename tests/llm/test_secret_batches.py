"""The secret scan holds a few texts at a time."""

import pyarrow as pa

from personalens.llm import secrets


def test_redacted_batches_are_small():
    texts = [*['password = "hunter2hunter2" ' + "x y " * 50_000] * 20, None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(22)), pa.array(texts), pa.array([7] * 22)], names=["doc_id", "text", "n_chars"])
    out = list(secrets._redacted("text", "n_chars")(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in out) <= 7
    assert [t for b in out for t in b.column("text").to_pylist()] == [t and secrets.redact(t) for t in texts]
    assert [n for b in out for n in b.column("n_chars").to_pylist()][-2:] == [7, 7]
    spans = [s for b in secrets._scan_batches(iter([batch])) for s in b.column("spans").to_pylist()]
    assert spans == [secrets.joined(secrets.scan(t or "")[1]) for t in texts]
