"""Requested ids that occur more than once."""

import numpy as np
import pyarrow as pa

from haulier.llm import token_files


def test_repeated_and_null_ids_are_all_read(tmp_path):
    path = tmp_path / "one.tokens"
    with pa.OSFile(str(path), "wb") as stream:
        writer = token_files.FrameWriter(stream, "<u2", frame_bytes=64)
        for doc_id, size in [(None, 2), (None, 3), (1, 4), *[(7, n) for n in range(40, 60)], (9, 1)]:
            writer.add(doc_id, np.arange(size, dtype="<u2").tobytes())
        assert writer.close() > 3
    with pa.OSFile(str(path), "rb") as file:
        reader = token_files.FrameReader(file)
        assert [(i, len(x)) for i, x in reader.chosen([7])] == [(7, n) for n in range(40, 60)]
        assert [(i, len(x)) for i, x in reader.chosen([None, 9])] == [(None, 2), (None, 3), (9, 1)]
