"""Streaming: intentionally empty.

The original works on one weekly snapshot file and has no stream source,
watermark, time window or stateful operator, so nothing is rebuilt here. A new
weekly snapshot is simply a new batch run of the fact-table build
(``weeklens.frames``).
"""
