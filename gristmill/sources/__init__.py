"""gristmill.sources"""
