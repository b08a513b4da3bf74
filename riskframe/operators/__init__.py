"""riskframe.operators"""
