"""Reusable DataFrame operators: flagging, joins, checks, profiles, history, keys."""
