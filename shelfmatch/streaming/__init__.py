"""shelfmatch.streaming"""
