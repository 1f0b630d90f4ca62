"""shelfmatch.operators"""
