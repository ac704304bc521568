"""User-level jobs: data set, windows, learners, forecasts, evaluation, selection."""
