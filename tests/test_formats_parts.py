"""Formats compared a part of the messages at a time."""

from couriermart.contract import MESSAGE_COLUMNS
from couriermart.session import path_exists, scratch_path, source_bytes
from couriermart.sources import formats, layout
from messages import messages
from test_slices import rows  # noqa: F401


def test_formats_by_parts(spark, rows):  # noqa: F811
    stored = layout._with_month(rows)
    parts = [part.select(*MESSAGE_COLUMNS) for part in layout.month_slices(stored, slice_bytes=source_bytes(rows) // 2)]
    root, whole = scratch_path(spark, "formats-parts"), scratch_path(spark, "formats-whole")
    assert len(parts) == 2
    merged = formats.surviving_parts(parts, root)
    expected = formats.survivors(rows, formats.compare_formats(rows, whole))
    assert merged.columns == expected.columns and merged.dtypes == expected.dtypes
    assert merged.collect() == expected.collect() and all(row.same_rows for row in merged.collect())
    assert not any(path_exists(spark, f"{root}/{i}/{name}") for i in range(2) for name in formats.FORMATS)
    nothing = formats.surviving_parts([messages(spark, [])], root)
    assert [(row.format, row.rows, row.price_sum, row.same_rows) for row in nothing.collect()] == [(name, 0, None, True) for name in formats.FORMATS]
