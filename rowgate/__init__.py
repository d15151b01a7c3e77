"""rowgate: clean, quarantine, check, judge and publish tables on Spark."""
