"""riskframe.functions"""
