"""gristmill.operators"""
