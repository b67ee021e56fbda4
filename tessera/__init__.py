"""Card-transaction mart, trigger stream and calendar jobs as Spark DataFrame jobs."""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
