"""Composed plans: normalisers, JSON tooling, the calendar and the analytic page queries."""
