"""tabloom: composable PySpark operators for wide, dirty, multi-source tables."""

__version__ = "0.1.0"
