from circulation.streaming.daily_catchup import RUN_DATE, default_checkpoint, load_run_dates, start_daily_catchup

__all__ = ["RUN_DATE", "default_checkpoint", "load_run_dates", "start_daily_catchup"]
