"""Streaming operators.

Empty on purpose: the reference's entry points are all one-shot batch jobs,
with no stream, watermark, trigger or state anywhere. Every operator in
:mod:`torqueframe.operators` is a plain DataFrame transformation, so the
stateless ones (filters, projections, lookups, flags) can run unchanged on a
``readStream`` DataFrame should a streaming source appear.
"""
