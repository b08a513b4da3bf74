"""riskframe.sources"""
