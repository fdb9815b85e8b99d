"""volspark: price-tick volatility analytics on PySpark (batch + Structured Streaming).

Entry points: ``volspark.operators.metrics.tick_metrics`` (rolling metrics),
``volspark.operators.analysis`` (daily stats, hourly pattern, spikes),
``volspark.streaming.stream.RollingMetricsSink`` (streaming), and
``volspark.plans.jobs`` (end-to-end jobs).
"""

__version__ = "0.1.0"
