"""Everything here is batch work; only the scorer can also read a stream.

It is stateless: each request meets stored maps and a stored model, so the batch code runs
on a streaming DataFrame unchanged.
"""

from breachline.streaming.scoring import score_new_files

__all__ = ["score_new_files"]
