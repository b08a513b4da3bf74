"""riskframe.streaming"""
