"""tideline.plans"""
