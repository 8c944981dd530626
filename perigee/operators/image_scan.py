"""Image records straight from recovered streams: metadata and row packets searched under two byte orders."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.recovery import reverse_words
from perigee.operators.science import best_view, plausible
from perigee.sources.scratch import written

# First words of metadata and row packets (the second for rows with unusual flags), and a row's parts.
META_WORD, ROW_WORDS = 0x0A1A, (0x0A18, 0x1218)
LEAST_ROW = 6 + 6 + 4

VIEWS = ("plain", "word32")

RECORDS = "capture_id long, view string, position int, offset long, kind string, packet binary, image_id long, row_payload_bytes int"


def record_candidates(pieces: DataFrame, meta_bytes: int | None) -> DataFrame:
    """All places of both views where a metadata packet (of meta_bytes, if given) or a row packet can stand, whole.

    pieces: as packetizer.pieces_of or join_pieces give them, of a multiple of 4 bytes, so that words are the stream's.
    """

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for capture, start, size, content in zip(*[frame[c] for c in ("capture_id", "start", "size", "content")], strict=True):
                for position, data in enumerate((content, reverse_words(content))):
                    view = np.frombuffer(data, np.uint8).astype(np.int64)
                    n = max(0, min(size, len(view) - 6))
                    word, length = view[:n] << 8 | view[1 : n + 1], (view[4 : n + 4] << 8 | view[5 : n + 5]) + 7
                    there = np.arange(n) + length <= len(view)
                    meta = (word == META_WORD) & there & (length == (length if meta_bytes is None else meta_bytes))
                    rows = np.isin(word, ROW_WORDS) & there & (length > LEAST_ROW) & (length % 2 == 0)
                    for at in np.flatnonzero(meta | rows):
                        own = data[at : at + int(length[at])]
                        about = ("metadata", own, None, None) if meta[at] else ("row", own, int.from_bytes(own[6:10]), len(own) - LEAST_ROW)
                        found.append((capture, VIEWS[position], position, start + int(at), *about))
            yield pd.DataFrame(found, columns=[x.split()[0] for x in RECORDS.split(", ")])

    return pieces.select("capture_id", "start", "size", "content").mapInPandas(search, RECORDS)


def scan_records(pieces: DataFrame, decode: Callable[[Column], dict[str, Column]], meta_bytes: int | None = None, from_packets: DataFrame | None = None) -> DataFrame:
    """Per capture the image records (metadata and rows, in order of offset) of the byte order with the better score.

    decode gives a metadata packet's image_id, roi_rows, roi_cols, n_cols and status. Metadata that can't be true goes;
    a row counts if its image is known in its view, and if it has the columns that the last metadata of the image with
    known columns tells. A view scores 10 for metadata and 1 for a row; ties go to the stream as it is. With from_packets
    (capture_id, records: how many image packets the packetizer found) a capture is given only if the scan finds more.
    """
    found = written(record_candidates(pieces, meta_bytes), "image-candidates")
    whose = ["capture_id", "view"]
    metadata = found.filter("kind = 'metadata'").drop("image_id")
    fields = decode(F.col("packet"))
    metadata, _ = plausible(metadata.withColumns(fields))
    known = metadata.filter("image_id is not null").groupBy(*whose, "image_id")
    known = known.agg(F.max_by("n_cols", F.when(F.col("n_cols").isNotNull(), F.col("offset"))).alias("_cols"))
    rows = found.filter("kind = 'row'").join(known, [*whose, "image_id"]).filter("_cols is null or row_payload_bytes = 2 * _cols")
    columns = ["capture_id", "view", "position", "offset", "kind", "image_id", "packet"]
    records = metadata.select(columns).unionByName(rows.select(columns))
    best = best_view(records, "capture_id").select("capture_id", "view", "score")
    chosen = records.join(best, whose)
    if from_packets is None:
        return chosen
    counts = chosen.groupBy("capture_id").agg(F.count("*").alias("_n")).join(from_packets, "capture_id", "left")
    more = counts.filter(F.col("_n") > F.coalesce("records", F.lit(0))).select("capture_id")
    return chosen.join(more, "capture_id", "left_semi")
