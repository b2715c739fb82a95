"""Operators: functions DataFrame -> DataFrame (papers, graph, ego, periods)."""
