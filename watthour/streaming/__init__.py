"""The hourly mean and the drift check on a stream of readings.

An addition to the batch runs: the same operators fed by Structured Streaming.
"""
