"""Clinical cohort analytics as PySpark DataFrame transformations."""

from wardline.config import SiteConfig
from wardline.plans.report import Report, run_report
from wardline.plans.study import Study

__all__ = ["Report", "SiteConfig", "Study", "run_report"]
