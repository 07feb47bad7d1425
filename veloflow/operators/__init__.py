"""Table operators: functions from DataFrame to DataFrame, used with ``df.transform``."""
