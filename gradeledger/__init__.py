"""Point-in-time credit-rating reports as Spark DataFrame plans."""

from gradeledger.config import ReportConfig

__all__ = ["ReportConfig"]
