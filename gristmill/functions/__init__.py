"""gristmill.functions"""
