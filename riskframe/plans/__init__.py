"""riskframe.plans"""
