"""Relational operators: curated tables, views, reports, profile, ranking, semantic measures, angles, audits."""
