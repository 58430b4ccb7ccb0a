"""Constants and helpers that test modules share."""

import contextlib
import io

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
