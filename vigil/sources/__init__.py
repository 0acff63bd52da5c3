"""Sources and sinks: raw CSV with a read report, thresholds, landing check, report/table sinks, model registry."""
