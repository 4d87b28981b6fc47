from podium.plans.panel import Panel, clean_history, clean_snapshot, run_report

__all__ = ["Panel", "clean_history", "clean_snapshot", "run_report"]
