"""tideline.streaming"""
